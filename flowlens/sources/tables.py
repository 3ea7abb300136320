"""Tables and views over the written folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from flowlens.operators import views
from flowlens.schemas import (
    NORMALIZED_PARTITIONS,
    NORMALIZED_SCHEMA,
    WINDOW_PARTITIONS,
    WINDOW_SCHEMA,
)
from flowlens.sinks.reports import report_path

DATABASE = "security_logs"


def _ddl(schema, partitions=()) -> str:
    """Column list with partition columns last."""
    fields = [f for f in schema.fields if f.name not in partitions]
    fields += [schema[p] for p in partitions]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def read_parquet_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A Parquet folder, or None when it does not exist yet. Only a
    missing path counts as "no data"; every other error is raised."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


# Report tables: name -> (sub folder, schema DDL).
REPORT_TABLES = {
    "report_attack_distribution": ("attack_distribution",
                                   "attack_category string, severity_level string, "
                                   "dataset_source string, event_count bigint"),
    "report_hourly_timeseries": ("hourly_timeseries",
                                 "hour_bucket timestamp, attack_category string, "
                                 "dataset_source string, event_count bigint"),
    "report_behavioral_profiles": ("behavioral_profiles",
                                   "src_ip string, dataset_source string, total_events bigint, "
                                   "attack_events bigint, avg_flow_duration double, "
                                   "avg_flow_bytes_s double, total_syn_flags bigint"),
    "report_benign_baseline": ("benign_baseline",
                               "benign_count bigint, avg_flow_duration double, avg_flow_bytes_s double, "
                               "avg_flow_packets_s double, avg_fwd_packets double, "
                               "avg_bwd_packets double, max_flow_bytes_s double, "
                               "generated_at timestamp"),
    "report_aggregation_summary": ("aggregation_summary",
                                   "dataset_source string, window_start_date string, "
                                   "window_count bigint, total_events bigint, "
                                   "avg_flow_bytes_s double, alert_windows bigint"),
}


def create_table(spark: SparkSession, name: str, schema, partitions, path: str) -> None:
    """An external table over a folder, with the partitions that are there. Over
    a file sink's folder Spark keeps none: it reads the sink's log."""
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema, partitions)}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    if _is_partitioned(spark, name):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def point_report_tables(spark: SparkSession, reports_path: str, database: str = DATABASE) -> None:
    """Point the report tables at the current version's folders."""
    for name, (sub, _) in REPORT_TABLES.items():
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{report_path(spark, reports_path, sub)}'")
            spark.catalog.refreshTable(f"{database}.{name}")


def register_tables(spark: SparkSession, normalized_path: str, windows_path: str,
                    reports_path: str | None = None, database: str = DATABASE,
                    batch_partition: bool = False, location: str | None = None) -> None:
    """C1 + C2: a database with the external tables over the folders, and
    their partitions discovered (``MSCK REPAIR TABLE``).

    Tables that the streaming jobs write are read through their sink's log,
    so new batches are seen as they come. For tables that batch jobs write,
    ``add_partitions`` adds a new batch's folders. ``batch_partition``
    declares an innermost ``batch_id`` partition (``write_batch_partitioned``).
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, path, schema, parts, batch_level in (
        ("normalized_logs", normalized_path, NORMALIZED_SCHEMA, NORMALIZED_PARTITIONS,
         batch_partition),
        ("aggregations_5min", windows_path, WINDOW_SCHEMA, WINDOW_PARTITIONS, False),
    ):
        extra = ["batch_id"] if batch_level else []
        cols = _ddl(schema, parts)
        if extra:
            cols += ", `batch_id` bigint"
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE {database}.{name} ({cols}) USING parquet "
            f"PARTITIONED BY ({', '.join(list(parts) + extra)}) LOCATION '{path}'"
        )
        if _is_partitioned(spark, f"{database}.{name}"):
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
        # else: the folder is a streaming file sink's output; Spark then reads
        # it through the sink's log (committed files only, partitions from it)
    if reports_path:
        for name, (sub, ddl) in REPORT_TABLES.items():
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.sql(
                f"CREATE TABLE {database}.{name} ({ddl}) USING parquet "
                f"LOCATION '{report_path(spark, reports_path, sub)}'"
            )


def refresh_tables(spark: SparkSession, database: str = DATABASE) -> None:
    """Let this session see what streams have written since it last read the
    tables: it drops the file listings that the session keeps."""
    for name in ("normalized_logs", "aggregations_5min"):
        spark.catalog.refreshTable(f"{database}.{name}")


def add_partitions(spark: SparkSession, table: str, written: DataFrame, partition_cols) -> None:
    """C2 after a batch: make the partitions of ``written`` (the rows just
    written, or their distinct partition values) known to the catalog. Only
    they are added; no folder is listed. The number of rows gathered is that
    of the batch's folders."""
    quote = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    found = written.select(*partition_cols).distinct().collect()
    if found:
        specs = " ".join("PARTITION (" + ", ".join(f"`{c}` = {quote(r[c])}" for c in partition_cols) + ")" for r in found)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def register_views(spark: SparkSession, database: str = DATABASE, as_of=None,
                   persistent: bool = False) -> None:
    """The four views (A7-A10) over the tables.

    By default temporary views built from the DataFrame functions; with
    ``persistent`` they are ``CREATE OR REPLACE VIEW`` statements in the
    database, so any SQL client of the catalog can query them.
    """
    if persistent:
        for name, body in views.VIEW_SQL.items():
            sql = body.format(db=database, as_of=views.as_of_sql(as_of))
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")
        return
    norm = spark.table(f"{database}.normalized_logs")
    windows = spark.table(f"{database}.aggregations_5min")
    views.recent_attacks(norm, as_of).createOrReplaceTempView("recent_attacks")
    views.top_src_ips(norm).createOrReplaceTempView("top_src_ips")
    views.hourly_traffic(norm).createOrReplaceTempView("hourly_traffic")
    views.active_alerts(windows, as_of).createOrReplaceTempView("active_alerts")
