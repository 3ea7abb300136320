"""Batch reports over normalised rows and the window table.

Every report is a hash aggregate with map-side partial aggregation: the
shuffle carries at most one partial row per group and input partition, so
a key that holds a third of all rows costs no more shuffle than any other.
Top-k reports plan as ``TakeOrderedAndProject`` (per-partition top-k, then
a merge of k rows per partition), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BENIGN = "Benign"


def _not_benign() -> Column:
    return F.col("attack_category") != F.lit(BENIGN)


def traffic_rollup(norm: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Event counts per hour, category, severity and source: one scan of the
    normalised table from which the attack distribution and the hourly
    series are both derived (its size is hours x categories x sources,
    independent of the number of flows)."""
    return norm.groupBy(
        F.date_trunc("hour", F.col(time_col)).alias("hour_bucket"),
        "attack_category", "severity_level", "dataset_source",
    ).agg(F.count(F.lit(1)).alias("event_count"))


def attack_distribution_from_rollup(rollup: DataFrame) -> DataFrame:
    """A2 from ``traffic_rollup``."""
    keys = ["attack_category", "severity_level", "dataset_source"]
    return (
        rollup.groupBy(*keys)
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy(F.desc("event_count"), *keys)
    )


def hourly_timeseries_from_rollup(rollup: DataFrame) -> DataFrame:
    """A3 from ``traffic_rollup``."""
    return (
        rollup.groupBy("hour_bucket", "attack_category", "dataset_source")
        .agg(F.sum("event_count").alias("event_count"))
        .orderBy("hour_bucket", "attack_category", "dataset_source")
    )


def attack_distribution(norm: DataFrame) -> DataFrame:
    """A2: events per category, severity and source, most first."""
    keys = ["attack_category", "severity_level", "dataset_source"]
    return (
        norm.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), *keys)
    )


def hourly_timeseries(norm: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """A3: events per hour, category and source, by hour."""
    return (
        norm.groupBy(
            F.date_trunc("hour", F.col(time_col)).alias("hour_bucket"),
            "attack_category", "dataset_source",
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("hour_bucket", "attack_category", "dataset_source")
    )


def behavioral_profiles(norm: DataFrame, top_n: int = 10_000) -> DataFrame:
    """A4 + L1: per-source profile, the ``top_n`` busiest sources.

    ``attack_events`` counts rows whose category is not Benign
    (``count_if``; a plain ``count`` of the comparison would count every
    non-NULL row). The NULL-address filter runs before the aggregate.
    """
    return (
        norm.filter(F.col("src_ip").isNotNull())
        .groupBy("src_ip", "dataset_source")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(_not_benign()).alias("attack_events"),
            F.avg("flow_duration").alias("avg_flow_duration"),
            F.avg("flow_bytes_s").alias("avg_flow_bytes_s"),
            F.sum("syn_flag_count").alias("total_syn_flags"),
        )
        .orderBy(F.desc("total_events"), "src_ip", "dataset_source")
        .limit(top_n)
    )


def benign_baseline(norm: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """A5: one row of benign statistics, or no row when there are no benign
    flows (the report is skipped then). The category filter prunes the
    partitioned table to its Benign directories."""
    agg = norm.filter(F.col("attack_category") == F.lit(BENIGN)).agg(
        F.count(F.lit(1)).alias("benign_count"),
        F.avg("flow_duration").alias("avg_flow_duration"),
        F.avg("flow_bytes_s").alias("avg_flow_bytes_s"),
        F.avg("flow_packets_s").alias("avg_flow_packets_s"),
        F.avg("total_fwd_packets").alias("avg_fwd_packets"),
        F.avg("total_bwd_packets").alias("avg_bwd_packets"),
        F.max("flow_bytes_s").alias("max_flow_bytes_s"),
    )
    out = agg.filter(F.col("benign_count") > 0)
    if generated_at is not False:
        out = out.withColumn(
            "generated_at", generated_at if generated_at is not None else F.current_timestamp()
        )
    return out


def aggregation_summary(windows: DataFrame) -> DataFrame:
    """Per source and day over the window table. ``avg_flow_bytes_s`` is
    the unweighted mean of the window means; ``alert_windows`` counts
    windows whose ``is_alert`` is true."""
    return (
        windows.groupBy("dataset_source", "window_start_date")
        .agg(
            F.count(F.lit(1)).alias("window_count"),
            F.sum("event_count").alias("total_events"),
            F.avg("avg_flow_bytes_s").alias("avg_flow_bytes_s"),
            F.count_if(F.col("is_alert")).alias("alert_windows"),
        )
        .orderBy("window_start_date", "dataset_source")
    )


# ---- dashboard reports (D1-D5) ------------------------------------------


def total_attacks(recent: DataFrame) -> DataFrame:
    """Total attacks over a ``recent_attacks`` result."""
    return recent.agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("total_attacks"))


def category_distribution(norm: DataFrame) -> DataFrame:
    """Events per category."""
    return (
        norm.groupBy("attack_category")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "attack_category")
    )


def hourly_attack_volume(norm: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """D3: attack events per hour (Benign excluded, NULL category dropped)."""
    return (
        norm.filter(_not_benign())
        .groupBy(F.date_trunc("hour", F.col(time_col)).alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("hour_bucket")
    )


def top_attack_types(norm: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent attack categories."""
    return (
        norm.filter(_not_benign())
        .groupBy("attack_category")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), "attack_category")
        .limit(n)
    )


def top_attack_sources(norm: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` sources with most attack events."""
    return (
        norm.filter(F.col("src_ip").isNotNull() & _not_benign())
        .groupBy("src_ip")
        .agg(F.count(F.lit(1)).alias("attack_events"))
        .orderBy(F.desc("attack_events"), "src_ip")
        .limit(n)
    )


def attack_heatmap(norm: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Attack events by day of week (1 = Sunday) and hour of day."""
    ts = F.col(time_col)
    return (
        norm.filter(_not_benign())
        .groupBy(F.dayofweek(ts).alias("day_of_week"), F.hour(ts).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy("day_of_week", "hour_of_day")
    )
