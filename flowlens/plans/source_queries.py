"""Registered source, sink and catalog checks.

Each check writes ``events`` (as raw flow messages) in a dataset's file
layout under a fresh folder of the shared directory, reads it back with
the library's sources, and returns the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.payload import forward_payload
from flowlens.operators import reports
from flowlens.operators.normalize import decode_json
from flowlens.operators.windows import window_metrics
from flowlens.plans import fixtures
from flowlens.plans.batch_queries import ALERT_EVENTS_THRESHOLD, ALERT_WIDTH, flows, rounded
from flowlens.plans.layout import REPORTS, TABLES, VIEWS, layout_columns
from flowlens.plans.oracle import AS_OF
from flowlens.plans.jobs import run_ingest, run_reports
from flowlens.plans.stream_queries import day_splits
from flowlens.schemas import (
    FLOW_FIELDS,
    NORMALIZED_PARTITIONS,
    NORMALIZED_SCHEMA,
    WINDOW_PARTITIONS,
)
from flowlens.session import new_work_dir
from flowlens.sinks.reports import read_report
from flowlens.sinks.writers import write_partitioned
from flowlens.sources.csv_sources import as_raw_messages, read_cicflow_csv, read_unsw_csv
from flowlens.sources.events_adapter import dealt_out, load_events, raw_flows
from flowlens.sources.files import CICDOS_DIRS, CICIDS_DIR, UNSW_DIR, dataset_files
from flowlens.sources.tables import register_tables, register_views
from flowlens.sources.zip_source import read_zip_csv
from flowlens.streaming.ingest_files import start_ingest

FIXED_CLOCK = 1704067200000  # 2024-01-01T00:00:00Z, the producer clock of the checks


def _raw(spark: SparkSession, sf_dir: str):
    events = load_events(spark, sf_dir)
    raw = raw_flows(dealt_out(events), keep=[(F.col("event_id") % 2).cast("string").alias("binary_label")])
    _, mid, _ = day_splits(events)
    first_half = F.col("event_time") < F.lit(mid.isoformat()).cast("timestamp")
    return raw, first_half


def _write_cic(raw: DataFrame, first_half, root: str) -> None:
    """cicids rows -> CIC-IDS-2017 (layout A); all other rows -> the two
    CIC-DDoS2019 folders (layout B for the first half of the days)."""
    is_cic = F.col("dataset_source") == "cicids"
    A, B = fixtures.CIC_HEADER_A, fixtures.CIC_HEADER_B
    fixtures.write_files(fixtures.cic_layout(raw.filter(is_cic), A), f"{root}/{CICIDS_DIR}",
                         "Monday-WorkingHours_", A)
    fixtures.write_files(fixtures.cic_layout(raw.filter(~is_cic & first_half), B),
                         f"{root}/{CICDOS_DIRS[0]}", "DrDoS_", B)
    fixtures.write_files(fixtures.cic_layout(raw.filter(~is_cic & ~first_half), A),
                         f"{root}/{CICDOS_DIRS[1]}", "Syn_", A)


def _write_unsw(raw: DataFrame, first_half, root: str) -> None:
    """All rows in the UNSW layout: headerless files for the first half of
    the days, files with a header line for the rest, and a ground-truth
    file whose name the selection skips."""
    d = f"{root}/{UNSW_DIR}"
    layout = fixtures.unsw_layout(raw.filter(first_half))
    fixtures.write_files(layout, d, "UNSW-NB15_", None)
    header = [f" {c.upper()} " if i % 2 else c for i, c in enumerate(fixtures.UNSW_COLUMNS)]
    fixtures.write_files(fixtures.unsw_layout(raw.filter(~first_half)), d, "UNSW-NB15_h", header)
    gt = raw.limit(0).select(F.lit("junk").alias("c0"))
    fixtures.write_files(gt, d, "NUSW-NB15_GT", ["Attack category"])


def q_csv_cicflow_source(spark, sf_dir):
    raw, first_half = _raw(spark, sf_dir)
    root = new_work_dir(spark, "cicflow")
    _write_cic(raw, first_half, root)
    files = dataset_files(spark, root)
    cic = as_raw_messages(read_cicflow_csv(spark, files["cicids"]), "cicids", F.lit(FIXED_CLOCK))
    dos = as_raw_messages(read_cicflow_csv(spark, files["cicdos"]), "cicdos", F.lit(FIXED_CLOCK))
    return cic.unionByName(dos).select(*FLOW_FIELDS, "dataset_source")


def q_csv_unsw_source(spark, sf_dir):
    raw, first_half = _raw(spark, sf_dir)
    root = new_work_dir(spark, "unsw")
    _write_unsw(raw, first_half, root)
    files = dataset_files(spark, root)
    unsw = as_raw_messages(read_unsw_csv(spark, files["unsw"]), "unsw", F.lit(FIXED_CLOCK))
    return unsw.select(*FLOW_FIELDS, "dataset_source")


def q_zip_csv_source(spark, sf_dir):
    raw, _ = _raw(spark, sf_dir)
    root = new_work_dir(spark, "zipcsv")
    A = fixtures.CIC_HEADER_A
    fixtures.write_files(fixtures.cic_layout(raw, A), f"{root}/{CICIDS_DIR}", "Tuesday_", A,
                         zipped=True)
    files = dataset_files(spark, root)["cicids"]
    out = as_raw_messages(read_zip_csv(spark, files), "cicids", F.lit(FIXED_CLOCK))
    return out.select(*FLOW_FIELDS, "dataset_source")


def q_publish_payload(spark, sf_dir):
    """J5 + K7: ingest all three layouts, read the published messages."""
    raw, first_half = _raw(spark, sf_dir)
    root = new_work_dir(spark, "ingest")
    _write_cic(raw.filter(F.col("dataset_source") != "unsw"), first_half, root)
    _write_unsw(raw.filter(F.col("dataset_source") == "unsw"), first_half, root)
    sink = f"{root}/published"
    run_ingest(spark, root, fmt="json", path=sink, produced_at=F.lit(FIXED_CLOCK))
    return spark.read.schema("key string, value string, topic string").json(sink)


def q_ingest_ledger(spark, sf_dir):
    """J5 with a ledger: three runs over one checkpoint, files of another
    dataset added after the first, none after the second; the published messages."""
    raw, first_half = _raw(spark, sf_dir)
    root = new_work_dir(spark, "ledger")
    data, sink = f"{root}/data", f"{root}/published"
    steps = [lambda: _write_cic(raw.filter(F.col("dataset_source") != "unsw"), first_half, data),
             lambda: _write_unsw(raw.filter(F.col("dataset_source") == "unsw"), first_half, data), lambda: None]
    for add_files in steps:
        add_files()
        q = start_ingest(spark, data, f"{root}/ledger", fmt="json", path=sink, produced_at=F.lit(FIXED_CLOCK), trigger={"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return spark.read.schema("key string, value string, topic string").json(sink).select("key", "value", "topic")


def q_json_round_trip(spark, sf_dir):
    """P8 + P6/P7: normalised rows -> forwarded JSON (K2) -> decoded rows."""
    norm = flows(spark, sf_dir)
    payload = forward_payload(norm)
    decoded = decode_json(payload, NORMALIZED_SCHEMA)
    return rounded(decoded)


def q_partitioned_tables(spark, sf_dir):
    """K1/K3 + S8/S9/C1-C2 + F3: write the partitioned tables, register
    them, repair partitions, and read the benign baseline and the per
    partition counts back through the catalog."""
    root = new_work_dir(spark, "tables")
    norm_path, win_path = f"{root}/normalized-logs", f"{root}/aggregations-5min"
    norm = flows(spark, sf_dir)
    write_partitioned(norm, norm_path, NORMALIZED_PARTITIONS)
    w = window_metrics(norm, width=ALERT_WIDTH, events_threshold=ALERT_EVENTS_THRESHOLD)
    write_partitioned(w, win_path, WINDOW_PARTITIONS)
    db = "flowlens_check_" + root.rstrip("/").rsplit("-", 1)[-1]
    register_tables(spark, norm_path, win_path, database=db, batch_partition=False,
                    location=f"{root}/catalog")
    table = spark.table(f"{db}.normalized_logs")
    counts = table.groupBy("attack_category", "partition_date").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.lit(None).cast("bigint").alias("benign_count"))
    base = reports.benign_baseline(table, generated_at=False).select(
        F.lit("Benign").alias("attack_category"), F.lit(None).cast("string").alias("partition_date"),
        F.lit(None).cast("bigint").alias("event_count"), "benign_count")
    return counts.unionByName(base)


def _tables(spark, sf_dir, name: str):
    """The partitioned tables, written by batch, with one report pass over
    them: (folder, normalised path, window path, reports path)."""
    root = new_work_dir(spark, name)
    norm_path, win_path, out = f"{root}/normalized-logs", f"{root}/aggregations-5min", f"{root}/reports"
    norm = flows(spark, sf_dir)
    write_partitioned(norm, norm_path, NORMALIZED_PARTITIONS)
    write_partitioned(window_metrics(norm), win_path, WINDOW_PARTITIONS)
    if not run_reports(spark, norm_path, win_path, out):
        raise RuntimeError("no normalised rows were written")
    return root, norm_path, win_path, out


def _report(name: str):
    """J3 + K6 + S8: one report pass; the named report read back."""
    def query(spark, sf_dir):
        out = _tables(spark, sf_dir, "reports")[-1]
        return rounded(read_report(spark, out, name).drop("generated_at"))

    return query


def _registered(spark, sf_dir, name: str) -> str:
    root, norm_path, win_path, out = _tables(spark, sf_dir, name)
    db = f"flowlens_{name}_" + root.rstrip("/").rsplit("-", 1)[-1]
    register_tables(spark, norm_path, win_path, reports_path=out, database=db, location=f"{root}/catalog")
    return db


def _rows(spark, db: str, relations: dict) -> DataFrame:
    """All rows of several relations of the catalog, in one layout."""
    return rounded(reduce(DataFrame.unionByName, [spark.table(f"{db}.{t}").selectExpr(*layout_columns(name)) for t, name in relations.items()]))


def q_catalog_tables(spark, sf_dir):
    """S9 + C1-C2: all rows of all seven tables, read through the catalog."""
    db = _registered(spark, sf_dir, "catalog")
    return _rows(spark, db, {**{t: t for t in TABLES}, **{f"report_{r}": r for r in REPORTS}})


def q_catalog_views(spark, sf_dir):
    """All rows of the four views in SQL over the catalog."""
    db = _registered(spark, sf_dir, "views")
    register_views(spark, database=db, as_of=AS_OF, persistent=True)
    return _rows(spark, db, {v: v for v in VIEWS})


QUERIES = {
    "csv_cicflow_source": q_csv_cicflow_source,
    "csv_unsw_source": q_csv_unsw_source,
    "zip_csv_source": q_zip_csv_source,
    "publish_payload": q_publish_payload,
    "ingest_ledger": q_ingest_ledger,
    "json_round_trip": q_json_round_trip,
    "partitioned_tables": q_partitioned_tables,
    "report_job": _report("hourly_timeseries"),
    "report_distribution": _report("attack_distribution"),
    "report_profiles": _report("behavioral_profiles"),
    "report_baseline": _report("benign_baseline"),
    "report_summary": _report("aggregation_summary"),
    "catalog_tables": q_catalog_tables,
    "catalog_views": q_catalog_views,
}
