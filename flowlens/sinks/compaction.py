"""Compaction of a streaming file sink's table (K1, K3, K5).

A sink writes files a micro-batch, category and day. The table's folder and
the sink's log are never touched: followers and the sink itself go on as
before. ``compact`` copies what the sink has committed into a segment of large
files under a folder of its own and commits a version that names the segments
and the modification time up to which they hold every committed file.
``read_live`` and the view of ``publish_view`` read the segments and, of the
sink's table, only later files (a filter on ``_metadata`` that prunes files
before they are opened).

Why no row is lost or read twice: one query writes the sink, batch after
batch. A file of a batch that is not committed yet is written after the last
committed batch, so it is newer than every committed file. The mark stays
``settle_seconds`` behind the newest committed file, which leaves room for
file systems with coarse clocks; files newer than the mark stay with the
sink's side. A row that arrives late, for a day that is compacted already, is
in a newer file and is read from there until the next compaction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.schemas import NORMALIZED_PARTITIONS, NORMALIZED_SCHEMA
from flowlens.sinks.versions import Version, Versions, small_tail
from flowlens.sinks.writers import write_partitioned
from flowlens.sources.tables import DATABASE, create_table

_WRITTEN = "_metadata.file_modification_time"


def _newer(mark: int | None) -> Column:
    return F.lit(True) if mark is None else F.col(_WRITTEN) > F.timestamp_micros(F.lit(mark))


def _table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def compact(spark: SparkSession, table_path: str, root: str, schema=NORMALIZED_SCHEMA, partitions=NORMALIZED_PARTITIONS,
            settle_seconds: float = 2.0) -> Version:
    """Copy the sink's committed files since the last version into a segment
    under ``root``; small segments before it are rewritten with it. Returns the
    version that then holds (the old one where there is nothing new)."""
    store = Versions(spark, root)
    now = store.current()
    fresh = _table(spark, table_path, schema).where(_newer(now.mark))  # one listing of the log for all that follows
    newest = fresh.agg(F.max(F.unix_micros(_WRITTEN))).first()[0]
    if newest is None:
        return now
    mark = newest - int(settle_seconds * 1_000_000)
    covered = fresh.where(F.col(_WRITTEN) <= F.timestamp_micros(F.lit(mark)))
    rows = covered.count()
    if not rows:
        return now
    merged = small_tail(now.segments, rows)
    kept, small = now.segments[:len(now.segments) - merged], now.segments[len(now.segments) - merged:]
    parts = covered.select(*schema.fieldNames())
    for s in small:
        parts = parts.unionByName(_table(spark, s["path"], schema))
    path = store.new_folder("segment")
    write_partitioned(parts, path, partitions, mode="errorifexists")
    rows += sum(s["rows"] for s in small)
    return store.commit(now, [*kept, {"path": path, "rows": rows}], mark)


def read_live(spark: SparkSession, table_path: str, root: str, schema=NORMALIZED_SCHEMA) -> DataFrame:
    """The table's rows: the current version's segments and the sink's newer files."""
    now = Versions(spark, root).current()
    columns = schema.fieldNames()
    out = _table(spark, table_path, schema).where(_newer(now.mark)).select(*columns)
    for path in now.paths():
        out = out.unionByName(_table(spark, path, schema).select(*columns))
    return out


def publish_view(spark: SparkSession, table_path: str, root: str, name: str = "normalized_logs", database: str = DATABASE,
                 schema=NORMALIZED_SCHEMA, partitions=NORMALIZED_PARTITIONS) -> Version:
    """Make ``database.name`` a view of the current version. Replacing the view
    is one change of the catalog: a reader sees the old version or the new.
    Tables of segments that only older versions name are dropped from the
    catalog (their files stay until ``Versions.drop_unused``)."""
    now = Versions(spark, root).current()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    have = {t.name: t for t in spark.catalog.listTables(database)}
    live = f"{name}_live"
    if live not in have:
        create_table(spark, f"{database}.{live}", schema, partitions, table_path)
    spark.catalog.refreshTable(f"{database}.{live}")  # a session keeps a table's listing until it is told
    columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
    newer = "" if now.mark is None else f" WHERE {_WRITTEN} > timestamp_micros({now.mark})"
    selects = [f"SELECT {columns} FROM {database}.{live}{newer}"]
    segments = []
    for path in now.paths():
        table = f"{name}_" + path.rsplit("/", 1)[-1].replace("-", "_")
        if table not in have:
            create_table(spark, f"{database}.{table}", schema, partitions, path)
        segments.append(table)
        selects.append(f"SELECT {columns} FROM {database}.{table}")
    if name in have and have[name].tableType != "VIEW":
        spark.sql(f"DROP TABLE {database}.{name}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {' UNION ALL '.join(selects)}")
    for table in have:
        if table.startswith(f"{name}_segment_") and table not in segments:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    return now
