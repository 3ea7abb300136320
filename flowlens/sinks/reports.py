"""Report tables that change as one (K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowlens.sinks.versions import Version, Versions

#: Reports that are skipped, and keep their last version, where they have no row.
SKIP_EMPTY = ("benign_baseline",)


def publish_reports(spark: SparkSession, frames: dict[str, DataFrame], root: str, database: str | None = None) -> Version:
    """Write the reports to a new folder and commit it as the current version.

    A report that ``frames`` does not hold keeps its last version, as does an
    empty one of ``SKIP_EMPTY``. With a ``database`` its report tables are then pointed at the
    new folders. The folders of the version before stay for readers that have
    planned on them; older ones are removed."""
    store = Versions(spark, root)
    now = store.current()
    folder = store.new_folder("pass")
    current = {s["name"]: s for s in now.segments if not s.get("old")}
    written = {}
    for name, frame in frames.items():
        frame.write.mode("errorifexists").parquet(f"{folder}/{name}")
        if name not in SKIP_EMPTY or not spark.read.schema(frame.schema).parquet(f"{folder}/{name}").isEmpty():
            written[name] = {"name": name, "path": f"{folder}/{name}"}
    # folders of the last version are named once more, as old ones, before they go
    old = [{**s, "old": True} for n, s in current.items() if n in written]
    out = store.commit(now, [*({**current, **written}).values(), *old], None)
    if database:
        from flowlens.sources.tables import point_report_tables

        point_report_tables(spark, root, database)
    store.drop_unused(now, out)
    return out


def report_path(spark: SparkSession, root: str, name: str) -> str:
    """The current folder of a report."""
    for s in Versions(spark, root).current().segments:
        if s["name"] == name and not s.get("old"):
            return s["path"]
    return f"{root.rstrip('/')}/{name}"


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(report_path(spark, root, name))
