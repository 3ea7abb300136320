"""Tumbling-window metrics and alerts.

Batch groups twice: first by window, keys, destination port and label, then
by window and keys. The first step only counts and sums, with map-side partial
aggregation in generated code; the second gathers the distinct ports and
labels of what is left. No row is copied (no Expand), and a hot source address
is spread over its ports and labels before the per-window merge.

A stream has one aggregate, so its distinct counts are
``size(collect_set(..))``: the state of a group holds the distinct labels and
destination ports of one window, never its rows. Ports are 16-bit in valid
flows; the parser does not enforce that, so a source that invents ports or
labels grows its own group's state until its window closes.
``distinct="set"`` uses that form in batch too, and ``distinct="approx"``
HyperLogLog sketches of fixed size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_WIDTH = "5 minutes"
DEFAULT_KEYS = ("src_ip", "dataset_source")
DEFAULT_EVENTS_THRESHOLD = 500
DEFAULT_SYN_THRESHOLD = 0.8


def _distinct(col: str, mode: str) -> Column:
    if mode == "set":
        return F.size(F.collect_set(F.col(col))).cast("bigint")
    if mode == "approx":
        return F.approx_count_distinct(F.col(col))
    raise ValueError(f"unknown distinct mode {mode!r}")


def _by_port_then_merged(flows: DataFrame, width: str, keys, time_col: str) -> DataFrame:
    """The exact measures of a batch, by way of one row a port and label."""
    means = ["flow_duration", "flow_bytes_s"]
    fine = flows.groupBy(F.window(F.col(time_col), width).alias("window"), *keys,
                         F.col("dst_port").alias("__port"), F.col("label").alias("__label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in means], *[F.count(m).alias(f"n_{m}") for m in means],
        F.sum("syn_flag_count").alias("syn"),
        F.sum("total_fwd_packets").alias("fwd"),
    )
    mean = lambda m: F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(f"avg_{m}")
    return fine.groupBy("window", *keys).agg(
        F.sum("n").alias("event_count"),
        _distinct("__label", "set").alias("unique_labels"),
        _distinct("__port", "set").alias("unique_dst_ports"),
        *[mean(m) for m in means],
        F.sum("syn").alias("total_syn_flags"),
        F.sum("fwd").alias("total_fwd_packets"),
    )


def window_aggregate(
    flows: DataFrame,
    width: str = DEFAULT_WIDTH,
    keys=DEFAULT_KEYS,
    time_col: str = "event_timestamp",
    distinct: str | None = None,
) -> DataFrame:
    """Group flows by tumbling window and keys; the seven window measures.

    ``distinct`` defaults to ``exact`` for batch and ``set`` for streams.
    """
    if distinct is None:
        distinct = "set" if flows.isStreaming else "exact"
    if distinct == "exact":
        return _by_port_then_merged(flows, width, keys, time_col)
    return flows.groupBy(F.window(F.col(time_col), width).alias("window"), *keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        _distinct("label", distinct).alias("unique_labels"),
        _distinct("dst_port", distinct).alias("unique_dst_ports"),
        F.avg("flow_duration").alias("avg_flow_duration"),
        F.avg("flow_bytes_s").alias("avg_flow_bytes_s"),
        F.sum("syn_flag_count").alias("total_syn_flags"),
        F.sum("total_fwd_packets").alias("total_fwd_packets"),
    )


def syn_flag_ratio(syn: Column, fwd: Column) -> Column:
    """SYN flags per forward packet when there are packets, else 0.0.
    A NULL SYN total with packets gives NULL."""
    return F.when(fwd > 0, syn / fwd).otherwise(F.lit(0.0))


def alert_flags(
    events_threshold: int = DEFAULT_EVENTS_THRESHOLD,
    syn_threshold: float = DEFAULT_SYN_THRESHOLD,
):
    """(is_alert, alert_reason) columns (P18, P19); ``is_alert`` is
    three-valued: NULL when the volume test fails and the ratio is NULL."""
    volume = F.col("event_count") > F.lit(events_threshold)
    syn = F.col("syn_flag_ratio") > F.lit(syn_threshold)
    is_alert = volume | syn
    reason = (
        F.when(volume & syn, F.lit("HIGH_VOLUME+SYN_FLOOD"))
        .when(volume, F.lit("HIGH_VOLUME"))
        .when(syn, F.lit("SYN_FLOOD"))
        .otherwise(F.lit(None).cast("string"))
    )
    return is_alert, reason


def finish_windows(
    agg: DataFrame,
    events_threshold: int = DEFAULT_EVENTS_THRESHOLD,
    syn_threshold: float = DEFAULT_SYN_THRESHOLD,
    processed_at: Column | None = None,
    keys=DEFAULT_KEYS,
) -> DataFrame:
    """Flatten the window, add ratio, alert flags and ``processed_at``."""
    with_ratio = agg.withColumn(
        "syn_flag_ratio", syn_flag_ratio(F.col("total_syn_flags"), F.col("total_fwd_packets"))
    )
    is_alert, reason = alert_flags(events_threshold, syn_threshold)
    return with_ratio.select(
        *keys,
        "event_count", "unique_labels", "unique_dst_ports", "avg_flow_duration",
        "avg_flow_bytes_s", "total_syn_flags", "total_fwd_packets", "syn_flag_ratio",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.date_format(F.col("window.start"), "yyyy-MM-dd").alias("window_start_date"),
        is_alert.alias("is_alert"),
        reason.alias("alert_reason"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
    )


def window_metrics(
    flows: DataFrame,
    width: str = DEFAULT_WIDTH,
    keys=DEFAULT_KEYS,
    events_threshold: int = DEFAULT_EVENTS_THRESHOLD,
    syn_threshold: float = DEFAULT_SYN_THRESHOLD,
    time_col: str = "event_timestamp",
    distinct: str | None = None,
) -> DataFrame:
    """The window table of Job 2: one row per (window, keys)."""
    agg = window_aggregate(flows, width, keys, time_col, distinct)
    return finish_windows(agg, events_threshold, syn_threshold, keys=keys)


def alerts(windows: DataFrame) -> DataFrame:
    """Alert rows only (F1): ``is_alert`` true, NULL dropped."""
    return windows.filter(F.col("is_alert"))


def latest_per_window(updates: DataFrame, version_col: str = "batch_id",
                      keys=("window_start", "src_ip", "dataset_source")) -> DataFrame:
    """Newest version of each window from an update-mode history.

    ``max_by`` over a struct is an ordinary aggregate, so it is partially
    aggregated before the shuffle; a window has at most one version per
    micro-batch.
    """
    others = [c for c in updates.columns if c not in keys and c != version_col]
    newest = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(version_col))
    return updates.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")
