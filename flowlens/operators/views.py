"""The four SQL views and the sample query as DataFrame functions.

``as_of`` replaces ``current_date``: a date string or column; the recent
filters keep partitions from the day before it onwards (date granular,
so 24 to 48 hours). On the partitioned tables the filter is on a
partition column and prunes directories before any file is opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.to_date(F.lit(str(as_of)))


def since_yesterday(col: str, as_of=None) -> Column:
    """``col >= yyyy-MM-dd of (as_of - 1 day)``, compared as text."""
    return F.col(col) >= F.date_format(F.date_sub(_as_of(as_of), 1), "yyyy-MM-dd")


def recent_attacks(norm: DataFrame, as_of=None) -> DataFrame:
    """Attacks since yesterday by category, severity, label, source."""
    keys = ["attack_category", "severity_level", "label", "dataset_source"]
    return (
        norm.filter(since_yesterday("partition_date", as_of) & (F.col("attack_category") != "Benign"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.desc("event_count"), *keys)
    )


def top_src_ips(norm: DataFrame, limit: int = 1000) -> DataFrame:
    """A8 + L2: sources by attack events, ``limit`` rows."""
    return (
        norm.filter(F.col("src_ip").isNotNull())
        .groupBy("src_ip", "dataset_source")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("attack_category") != "Benign").alias("attack_events"),
            F.max("syn_flag_count").alias("max_syn_flag_count"),
        )
        .orderBy(F.desc("attack_events"), "src_ip", "dataset_source")
        .limit(limit)
    )


def hourly_traffic(norm: DataFrame, time_col: str = "event_timestamp") -> DataFrame:
    """Events and mean byte rate per hour, category, source; newest first."""
    return (
        norm.groupBy(
            F.date_trunc("hour", F.col(time_col)).alias("hour_bucket"),
            "attack_category", "dataset_source",
        )
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("flow_bytes_s").alias("avg_flow_bytes_s"),
        )
        .orderBy(F.desc("hour_bucket"), "attack_category", "dataset_source")
    )


def active_alerts(windows: DataFrame, as_of=None) -> DataFrame:
    """A10: alert windows since yesterday, newest first; no grouping."""
    return (
        windows.filter(F.col("is_alert") & since_yesterday("window_start_date", as_of))
        .select("src_ip", "dataset_source", "event_count", "syn_flag_ratio",
                "alert_reason", "window_start", "window_end")
        .orderBy(F.desc("window_start"), "src_ip", "dataset_source")
    )


def attack_counts_24h(norm: DataFrame, as_of=None) -> DataFrame:
    """Events by category and severity since yesterday, most first."""
    return (
        norm.filter(since_yesterday("partition_date", as_of))
        .groupBy("attack_category", "severity_level")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "attack_category", "severity_level")
    )


# The views as Spark SQL over the catalog tables (C3), for SQL clients.
# ``{db}`` is the database, ``{as_of}`` a date expression (``current_date()``).
VIEW_SQL = {
    "recent_attacks": (
        "SELECT attack_category, severity_level, label, dataset_source, COUNT(*) AS event_count "
        "FROM {db}.normalized_logs "
        "WHERE partition_date >= date_format(date_sub({as_of}, 1), 'yyyy-MM-dd') "
        "AND attack_category <> 'Benign' "
        "GROUP BY attack_category, severity_level, label, dataset_source "
        "ORDER BY event_count DESC, attack_category, severity_level, label, dataset_source"
    ),
    "top_src_ips": (
        "SELECT src_ip, dataset_source, COUNT(*) AS total_events, "
        "COUNT_IF(attack_category <> 'Benign') AS attack_events, "
        "MAX(syn_flag_count) AS max_syn_flag_count "
        "FROM {db}.normalized_logs WHERE src_ip IS NOT NULL "
        "GROUP BY src_ip, dataset_source "
        "ORDER BY attack_events DESC, src_ip, dataset_source LIMIT 1000"
    ),
    "hourly_traffic": (
        "SELECT date_trunc('HOUR', event_timestamp) AS hour_bucket, attack_category, "
        "dataset_source, COUNT(*) AS event_count, AVG(flow_bytes_s) AS avg_flow_bytes_s "
        "FROM {db}.normalized_logs GROUP BY 1, 2, 3 "
        "ORDER BY hour_bucket DESC, attack_category, dataset_source"
    ),
    "active_alerts": (
        "SELECT src_ip, dataset_source, event_count, syn_flag_ratio, alert_reason, "
        "window_start, window_end FROM {db}.aggregations_5min "
        "WHERE is_alert = true "
        "AND window_start_date >= date_format(date_sub({as_of}, 1), 'yyyy-MM-dd') "
        "ORDER BY window_start DESC, src_ip, dataset_source"
    ),
}


def as_of_sql(as_of=None) -> str:
    """``current_date()`` or a date literal for ``VIEW_SQL``."""
    if as_of is None:
        return "current_date()"
    text = str(as_of)
    if not (len(text) == 10 and text[4] == "-" and text[7] == "-" and text.replace("-", "").isdigit()):
        raise ValueError(f"as_of must be yyyy-MM-dd, got {as_of!r}")
    return f"DATE '{text}'"
