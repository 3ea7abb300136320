"""Batch jobs: ingest (J5) and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.payload import publish_payload
from flowlens.operators import reports
from flowlens.schemas import NORMALIZED_SCHEMA, WINDOW_SCHEMA, with_fields
from flowlens.session import shared_dir
from flowlens.sinks.reports import publish_reports
from flowlens.sources.csv_sources import as_raw_messages, read_cicflow_csv, read_unsw_csv
from flowlens.sources.files import dataset_files
from flowlens.sources.tables import read_parquet_or_none
from flowlens.sources.zip_source import read_zip_csv

# Dataset -> raw topic.
RAW_TOPIC = {"cicids": "raw-cicids", "unsw": "raw-unsw", "cicdos": "raw-cicdos"}


def read_datasets(spark: SparkSession, root: str, produced_at: Column | None = None) -> DataFrame:
    """S1-S4 + P1-P5: every dataset file under ``root`` as raw messages."""
    out = read_files(spark, dataset_files(spark, root), produced_at)
    if out is None:
        raise FileNotFoundError(f"no dataset files under {root}")
    return out


def read_files(spark: SparkSession, files: dict[str, list[str]], produced_at: Column | None = None) -> DataFrame | None:
    """The given files of each dataset as raw messages; None without any."""
    frames = []
    cic_csv = [f for f in files["cicids"] if f.lower().endswith(".csv")]
    cic_zip = [f for f in files["cicids"] if f.lower().endswith(".zip")]
    if cic_csv:
        frames.append(as_raw_messages(read_cicflow_csv(spark, cic_csv), "cicids", produced_at))
    if cic_zip:
        frames.append(as_raw_messages(read_zip_csv(spark, cic_zip), "cicids", produced_at))
    if files["unsw"]:
        frames.append(as_raw_messages(read_unsw_csv(spark, files["unsw"]), "unsw", produced_at))
    if files["cicdos"]:
        frames.append(as_raw_messages(read_cicflow_csv(spark, files["cicdos"]), "cicdos", produced_at))
    return reduce(DataFrame.unionByName, frames) if frames else None


def run_ingest(spark: SparkSession, root: str, fmt: str = "kafka", path: str | None = None,
               options: dict | None = None, produced_at: Column | None = None) -> None:
    """Read the datasets once and publish keyed JSON messages (K7) to
    the dataset's raw topic (a ``topic`` column for Kafka; a ``topic=``
    folder for file formats)."""
    publish_messages(read_datasets(spark, root, produced_at), fmt, path, options)


def publish_messages(raw: DataFrame, fmt: str, path: str | None, options: dict | None = None, mode: str = "append") -> None:
    """K7: raw messages as keyed JSON to their dataset's topic."""
    topic = F.create_map(*[x for k, v in RAW_TOPIC.items() for x in (F.lit(k), F.lit(v))])[
        F.col("dataset_source")
    ]
    payload = publish_payload(raw.withColumn("topic", topic), keep=["topic"])
    if fmt == "kafka":
        payload.write.format("kafka").options(**(options or {})).save()
    else:
        payload.write.mode(mode).partitionBy("topic").format(fmt).options(**(options or {})).save(path)


def run_reports(spark: SparkSession, normalized_path: str, windows_path: str, reports_path: str,
                database: str | None = None) -> bool:
    """J3, one pass over the whole history: the five reports, published as one
    version (K6). ``streaming.report_state`` does it from new rows alone.

    Returns False (and publishes nothing) when there is no normalised data
    yet. Each report reads only its columns; the benign baseline reads
    only the ``attack_category=Benign`` directories. The big table is
    scanned three times: the hourly rollup (feeds two reports), the source
    profiles and the benign baseline.
    """
    norm = read_parquet_or_none(spark, normalized_path,
                                with_fields(NORMALIZED_SCHEMA, ("batch_id", "bigint")))
    if norm is None or norm.limit(1).count() == 0:
        return False
    norm = norm.select(*NORMALIZED_SCHEMA.fieldNames())
    # one scan feeds both the distribution and the hourly series; the
    # rollup is small and is written to the shared checkpoint folder
    shared_dir(spark)
    rollup = reports.traffic_rollup(norm).checkpoint()
    frames = {
        "attack_distribution": reports.attack_distribution_from_rollup(rollup),
        "hourly_timeseries": reports.hourly_timeseries_from_rollup(rollup),
        "behavioral_profiles": reports.behavioral_profiles(norm),
        "benign_baseline": reports.benign_baseline(norm),  # no row, no new report
    }
    windows = read_parquet_or_none(spark, windows_path, WINDOW_SCHEMA)
    if windows is not None:
        frames["aggregation_summary"] = reports.aggregation_summary(windows)
    publish_reports(spark, frames, reports_path, database)
    return True
