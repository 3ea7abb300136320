"""The five reports from mergeable partial aggregates.

Two queries follow the normalised table and the window table. Each micro-batch
reads only the files that are new, reduces them to partial aggregates (counts,
sums with their counts, maxima) and commits them as a segment of the state,
with the batch's number as mark: a batch that is run again after a failure
finds its number and adds nothing. Segments merge by adding up; small ones are
rewritten together, so a pass over the state reads few files whose size is
that of the groups, not of the history.

The reports are written to a new folder and made current by one commit
(``publish_reports``): a reader finds the five reports of one pass, old or
new, and a pass that fails leaves the old ones.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators import reports
from flowlens.schemas import NORMALIZED_SCHEMA, WINDOW_SCHEMA
from flowlens.sinks.reports import publish_reports
from flowlens.sinks.versions import Versions, small_tail
from flowlens.streaming.jobs import follow_table, start_query

#: Columns whose mean the benign baseline reports.
BASELINE_MEANS = {"avg_flow_duration": "flow_duration", "avg_flow_bytes_s": "flow_bytes_s", "avg_flow_packets_s": "flow_packets_s",
                  "avg_fwd_packets": "total_fwd_packets", "avg_bwd_packets": "total_bwd_packets"}
PROFILE_MEANS = {"avg_flow_duration": "flow_duration", "avg_flow_bytes_s": "flow_bytes_s"}
SUMMARY_MEANS = {"avg_flow_bytes_s": "avg_flow_bytes_s"}

KEYS = {
    "rollup": ["hour_bucket", "attack_category", "severity_level", "dataset_source"],
    "profiles": ["src_ip", "dataset_source"],
    "summary": ["dataset_source", "window_start_date"],
}


def _sums(means: dict[str, str]) -> list:
    """Sum and count of each column: what a mean is merged from."""
    out = []
    for name, column in means.items():
        out += [F.sum(F.col(column).cast("double")).alias(f"sum_{name}"), F.count(column).alias(f"n_{name}")]
    return out


def rollup_partial(norm: DataFrame) -> DataFrame:
    """Per hour, category, severity and source: the distribution, the hourly
    series and the benign baseline are all derived from it."""
    hour = F.date_trunc("hour", F.col("event_timestamp")).alias("hour_bucket")
    return norm.groupBy(hour, *KEYS["rollup"][1:]).agg(
        F.count(F.lit(1)).alias("event_count"), *_sums(BASELINE_MEANS), F.max("flow_bytes_s").alias("max_flow_bytes_s"))


def profiles_partial(norm: DataFrame) -> DataFrame:
    return norm.where("src_ip IS NOT NULL").groupBy(*KEYS["profiles"]).agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if(F.col("attack_category") != reports.BENIGN).alias("attack_events"),
        *_sums(PROFILE_MEANS), F.sum("syn_flag_count").alias("total_syn_flags"))


def summary_partial(windows: DataFrame) -> DataFrame:
    return windows.groupBy(*KEYS["summary"]).agg(
        F.count(F.lit(1)).alias("window_count"), F.sum("event_count").alias("total_events"), *_sums(SUMMARY_MEANS),
        F.count_if("is_alert").alias("alert_windows"))


FLOW_PARTIALS: dict[str, Callable[[DataFrame], DataFrame]] = {"rollup": rollup_partial, "profiles": profiles_partial}
WINDOW_PARTIALS: dict[str, Callable[[DataFrame], DataFrame]] = {"summary": summary_partial}


def merge_partials(parts: list[DataFrame], name: str) -> DataFrame:
    """Partial aggregates of one kind added up (maxima: the greatest)."""
    keys = KEYS[name]
    rows = reduce(DataFrame.unionByName, parts)
    values = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[(F.max(c) if c.startswith("max_") else F.sum(c)).alias(c) for c in values])


def fold_batch(batch: DataFrame, batch_id: int, store: Versions, partials: dict) -> None:
    """Add one micro-batch to the state, once."""
    spark, now = store.spark, store.current()
    if now.mark is not None and now.mark >= batch_id:
        return
    path = store.new_folder(f"batch-{int(batch_id)}")
    for name, partial in partials.items():
        partial(batch).write.parquet(f"{path}/{name}")
    rows = sum(spark.read.parquet(f"{path}/{name}").count() for name in partials)
    merged = small_tail(now.segments, rows)
    kept, small = now.segments[:len(now.segments) - merged], now.segments[len(now.segments) - merged:]
    if small:
        parts, path = [path, *[s["path"] for s in small]], store.new_folder(f"merged-{int(batch_id)}")
        for name in partials:
            merge_partials([spark.read.parquet(f"{p}/{name}") for p in parts], name).write.parquet(f"{path}/{name}")
        rows = sum(spark.read.parquet(f"{path}/{name}").count() for name in partials)
    store.commit(now, [*kept, {"path": path, "rows": rows}], int(batch_id))


def start_state(spark: SparkSession, table_path: str, schema, partials: dict, root: str, checkpoint: str,
                trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Follow a table and keep its partial aggregates under ``root``."""
    store = Versions(spark, root)
    rows = follow_table(spark, table_path, schema)
    writer = rows.writeStream.foreachBatch(lambda batch, batch_id: fold_batch(batch, batch_id, store, partials))
    return start_query(writer, checkpoint, trigger, name)


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The merged aggregates of one kind; None before the first batch."""
    paths = Versions(spark, root).current().paths()
    return merge_partials([spark.read.parquet(f"{p}/{name}") for p in paths], name) if paths else None


def _means(means: dict[str, str]) -> list:
    return [(F.col(f"sum_{m}") / F.when(F.col(f"n_{m}") > 0, F.col(f"n_{m}"))).alias(m) for m in means]


def reports_of_state(spark: SparkSession, state: str, top_n: int = 10_000) -> dict[str, DataFrame]:
    """The reports that the state gives (the baseline has no row without benign flows)."""
    out = {}
    rollup, profiles, summary = (read_state(spark, f"{state}/{d}", n) for d, n in (("flows", "rollup"), ("flows", "profiles"), ("windows", "summary")))
    if rollup is not None:
        out["attack_distribution"] = reports.attack_distribution_from_rollup(rollup)
        out["hourly_timeseries"] = reports.hourly_timeseries_from_rollup(rollup)
        out["behavioral_profiles"] = profiles.select(
            *KEYS["profiles"], "total_events", "attack_events", *_means(PROFILE_MEANS), "total_syn_flags",
        ).orderBy(F.desc("total_events"), "src_ip", "dataset_source").limit(top_n)
        benign = rollup.where(F.col("attack_category") == reports.BENIGN).agg(
            F.sum("event_count").alias("benign_count"),
            *[F.sum(f"{p}_{m}").alias(f"{p}_{m}") for m in BASELINE_MEANS for p in ("sum", "n")], F.max("max_flow_bytes_s").alias("max_flow_bytes_s"))
        out["benign_baseline"] = benign.where("benign_count > 0").select(
            "benign_count", *_means(BASELINE_MEANS), "max_flow_bytes_s", F.current_timestamp().alias("generated_at"))
    if summary is not None:
        out["aggregation_summary"] = summary.select(
            *KEYS["summary"], "window_count", "total_events", *_means(SUMMARY_MEANS), "alert_windows",
        ).orderBy("window_start_date", "dataset_source")
    return out


def update_reports(spark: SparkSession, normalized_path: str, windows_path: str, state: str, checkpoint: str, reports_path: str,
                   database: str | None = None) -> bool:
    """J3, one pass: take in what is new in both tables, then publish the five
    reports. Returns False, and publishes nothing, before the first flow."""
    state, checkpoint = state.rstrip("/"), checkpoint.rstrip("/")
    once = {"availableNow": True}
    queries = [start_state(spark, normalized_path, NORMALIZED_SCHEMA, FLOW_PARTIALS, f"{state}/flows", f"{checkpoint}/flows", once),
               start_state(spark, windows_path, WINDOW_SCHEMA, WINDOW_PARTIALS, f"{state}/windows", f"{checkpoint}/windows", once)]
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    frames = reports_of_state(spark, state)
    if "attack_distribution" not in frames:
        return False
    publish_reports(spark, frames, reports_path, database)
    return True
