"""Registered batch queries: each reads the driver's tables and runs one
operator group of the library over the whole of ``events``.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns carry the same names as the matching DuckDB SQL in
``flowlens.plans.oracle``. Clock columns (``processed_at``,
``generated_at``) are left out; doubles are rounded with ``stable_round``.
"""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from flowlens.functions.classify import register_sql_functions
from flowlens.functions.sanitize import label_fallback, safe_text, stable_round
from flowlens.operators import reports, views
from flowlens.operators.normalize import normalize
from flowlens.operators.sketches import DEFAULT_COUNTED, distinct_counts, merge_sketches, relative_error, window_sketches
from flowlens.operators.windows import alerts, window_metrics
from flowlens.plans.oracle import AS_OF
from flowlens.schemas import FLOW_FIELDS
from flowlens.sources.events_adapter import dense_raw_flows, dirty_raw_flows, load_events, raw_flows

ALERT_WIDTH = "1 day"
ALERT_EVENTS_THRESHOLD = 3


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column for comparison."""
    return df.select(*[
        stable_round(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised flows of ``events``, stamped with the event time."""
    return normalize(raw_flows(load_events(spark, sf_dir)), event_time="event_time")


def day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window table with 1-day windows and an event threshold of 3,
    where every alert reason occurs."""
    return window_metrics(flows(spark, sf_dir), width=ALERT_WIDTH,
                          events_threshold=ALERT_EVENTS_THRESHOLD)


def q_classify_severity(spark, sf_dir):
    f = flows(spark, sf_dir)
    return f.select("label", "attack_category", "severity_level", "dataset_source", "produced_at_ts")


def q_normalize_raw(spark, sf_dir):
    dirty = dirty_raw_flows(load_events(spark, sf_dir))
    cleaned = dirty.select(
        *[safe_text(c).alias(c) for c in FLOW_FIELDS],
        "dataset_source", "produced_at_ts", "event_time", safe_text("binary_label").alias("binary_label"),
    )
    is_unsw = F.col("dataset_source") == "unsw"
    with_label = cleaned.withColumn(
        "label", F.when(is_unsw, label_fallback(F.col("label"), F.col("binary_label"))).otherwise(F.col("label"))
    )
    return rounded(normalize(with_label, event_time="event_time"))


def q_attack_distribution(spark, sf_dir):
    return reports.attack_distribution(flows(spark, sf_dir))


def q_hourly_timeseries(spark, sf_dir):
    return reports.hourly_timeseries(flows(spark, sf_dir))


def q_behavioral_profiles(spark, sf_dir):
    return rounded(reports.behavioral_profiles(flows(spark, sf_dir)))


def q_benign_baseline(spark, sf_dir):
    return rounded(reports.benign_baseline(flows(spark, sf_dir), generated_at=False))


def _windows_out(w: DataFrame) -> DataFrame:
    return rounded(w.drop("processed_at"))


def dense_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised flows of the dense variant: few addresses, full windows."""
    return normalize(dense_raw_flows(load_events(spark, sf_dir)), event_time="event_time")


def q_window_metrics_5m(spark, sf_dir):
    return _windows_out(window_metrics(dense_flows(spark, sf_dir), width="5 minutes"))


def q_window_alerts_5m(spark, sf_dir):
    """The default width and thresholds."""
    return _windows_out(alerts(window_metrics(dense_flows(spark, sf_dir))))


def q_sql_functions(spark, sf_dir):
    """The two mappings as SQL functions."""
    register_sql_functions(spark)
    view = f"flows_{zlib.crc32(sf_dir.encode())}"
    raw_flows(load_events(spark, sf_dir)).createOrReplaceTempView(view)
    return spark.sql("SELECT label, classify_label(label) AS attack_category, severity_of(classify_label(label)) AS severity_level, "
                     f"produced_at_ts FROM {view}")


def q_window_metrics_1d(spark, sf_dir):
    return _windows_out(day_windows(spark, sf_dir))


def q_window_metrics_dst_port(spark, sf_dir):
    """Windows keyed by destination port (1 hour, threshold 5,000)."""
    w = window_metrics(flows(spark, sf_dir), width="1 hour", keys=("dst_port", "dataset_source"),
                       events_threshold=5000)
    return _windows_out(w)


def q_window_alerts(spark, sf_dir):
    return _windows_out(alerts(day_windows(spark, sf_dir)))


def q_aggregation_summary(spark, sf_dir):
    return rounded(reports.aggregation_summary(day_windows(spark, sf_dir)))


def q_recent_attacks(spark, sf_dir):
    return views.recent_attacks(flows(spark, sf_dir), as_of=AS_OF)


def q_top_src_ips(spark, sf_dir):
    return views.top_src_ips(flows(spark, sf_dir))


def q_hourly_traffic(spark, sf_dir):
    return rounded(views.hourly_traffic(flows(spark, sf_dir)))


def q_active_alerts(spark, sf_dir):
    return rounded(views.active_alerts(day_windows(spark, sf_dir), as_of=AS_OF))


def q_sample_active_alerts(spark, sf_dir):
    """``SELECT * FROM active_alerts LIMIT 20`` over the registered view."""
    view = f"active_alerts_{zlib.crc32(sf_dir.encode())}"
    views.active_alerts(day_windows(spark, sf_dir), as_of=AS_OF).createOrReplaceTempView(view)
    return rounded(spark.sql(f"SELECT * FROM {view} LIMIT 20"))


def q_sample_top_src_ips(spark, sf_dir):
    """``SELECT * FROM top_src_ips LIMIT 10`` over the registered view."""
    view = f"top_src_ips_{zlib.crc32(sf_dir.encode())}"
    views.top_src_ips(flows(spark, sf_dir)).createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {view} LIMIT 10")


def q_attack_counts_24h(spark, sf_dir):
    return views.attack_counts_24h(flows(spark, sf_dir), as_of=AS_OF)


def q_total_attacks_24h(spark, sf_dir):
    return reports.total_attacks(views.recent_attacks(flows(spark, sf_dir), as_of=AS_OF))


def q_category_distribution(spark, sf_dir):
    return reports.category_distribution(flows(spark, sf_dir))


def q_hourly_attack_volume(spark, sf_dir):
    return reports.hourly_attack_volume(flows(spark, sf_dir))


def q_top_attack_types(spark, sf_dir):
    return reports.top_attack_types(flows(spark, sf_dir))


def q_top_attack_sources(spark, sf_dir):
    return reports.top_attack_sources(flows(spark, sf_dir))


def q_attack_heatmap(spark, sf_dir):
    return reports.attack_heatmap(flows(spark, sf_dir))


#: Widest gap that the checks accept between a merged sketch's count and the exact one.
SKETCH_ERRORS = 4


def q_day_distincts(spark, sf_dir):
    """A1 + A6 with sketches: 5-minute windows merged to hours, hours to days;
    exact counts, and whether the sketches are within four standard errors."""
    norm = flows(spark, sf_dir)
    days = distinct_counts(merge_sketches(merge_sketches(window_sketches(norm), "1 hour"), "1 day"))
    exact = norm.groupBy(F.window("event_timestamp", "1 day").getField("start").alias("window_start"), "dataset_source").agg(
        *[F.count_distinct(c).alias(c) for c in DEFAULT_COUNTED])
    near = lambda c: F.abs(F.col(f"unique_{c}") - F.col(c)) <= F.ceil(SKETCH_ERRORS * relative_error() * F.col(c))
    return days.join(exact, ["window_start", "dataset_source"]).select(
        "window_start", "dataset_source", "event_count", *DEFAULT_COUNTED, *[near(c).alias(f"near_{c}") for c in DEFAULT_COUNTED])


def q_baseline_filters(spark, sf_dir):
    """the benign baseline of all flows, of those without benign ones, and of
    none; the report is skipped (no row) in the last two."""
    norm = flows(spark, sf_dir)
    cases = {"all": norm, "no_benign": norm.where("attack_category <> 'Benign'"), "no_flows": norm.where("partition_date IS NULL")}
    rows = [reports.benign_baseline(own, generated_at=False).select(F.lit(name).alias("input"), "benign_count") for name, own in cases.items()]
    sizes = [own.agg(F.count(F.lit(1)).alias("benign_count")).select(F.lit(f"{name}_flows").alias("input"), "benign_count") for name, own in cases.items()]
    return reduce(DataFrame.unionByName, [*rows, *sizes])


QUERIES = {
    "day_distincts": q_day_distincts,
    "baseline_filters": q_baseline_filters,
    "classify_severity": q_classify_severity,
    "normalize_raw": q_normalize_raw,
    "attack_distribution": q_attack_distribution,
    "hourly_timeseries": q_hourly_timeseries,
    "behavioral_profiles": q_behavioral_profiles,
    "benign_baseline": q_benign_baseline,
    "window_metrics_5m": q_window_metrics_5m,
    "window_alerts_5m": q_window_alerts_5m,
    "sql_functions": q_sql_functions,
    "window_metrics_1d": q_window_metrics_1d,
    "window_metrics_dst_port": q_window_metrics_dst_port,
    "window_alerts": q_window_alerts,
    "aggregation_summary": q_aggregation_summary,
    "recent_attacks": q_recent_attacks,
    "top_src_ips": q_top_src_ips,
    "hourly_traffic": q_hourly_traffic,
    "active_alerts": q_active_alerts,
    "attack_counts_24h": q_attack_counts_24h,
    "sample_active_alerts": q_sample_active_alerts,
    "sample_top_src_ips": q_sample_top_src_ips,
    "total_attacks_24h": q_total_attacks_24h,
    "category_distribution": q_category_distribution,
    "hourly_attack_volume": q_hourly_attack_volume,
    "top_attack_types": q_top_attack_types,
    "top_attack_sources": q_top_attack_sources,
    "attack_heatmap": q_attack_heatmap,
}
