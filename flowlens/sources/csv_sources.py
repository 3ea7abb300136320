"""CSV sources of the three flow datasets (S1, S3) and the raw-message
projection of their rows (P1-P5).

Cells stay text. Files are read in groups that share a header line, so
every file is bound by its own column names; groups are combined with
``unionByName``. An unquoted empty cell, which Spark reads as NULL, is
turned back into ``''`` for columns the file has; a column the file lacks
is NULL. Blank lines are no rows.

A quoted cell may hold line breaks. Such files are cut into splits whose
state (inside quotes or not) is worked out first (``sources.split_csv``); every
other file is split by Spark as usual. By default (``multi_line=None``) one text
scan finds the files that have a line with an odd number of quotes; pass True
or False where that is known.
"""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.sanitize import label_fallback, safe_text
from flowlens.schemas import CICFLOW_COLUMN_MAP, FLOW_FIELDS, UNSW_COLUMN_MAP, UNSW_SCHEMA
from flowlens.sources.files import group_by_first_line, qualified
from flowlens.sources.split_csv import SPLIT_BYTES, read_split_csv

# Quoting as RFC 4180 and pandas read it: a doubled quote inside a quoted
# cell is one quote; a backslash is an ordinary character.
CSV_OPTIONS = {
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _pick_cols(mapping: dict, present: set) -> list[Column]:
    """Mapped columns by name: '' for empty cells of present columns, NULL
    for absent ones; then NaN/infinity text to NULL (P1, P3)."""
    cols = []
    for src, dst in mapping.items():
        c = F.coalesce(F.col(f"`{src}`"), F.lit("")) if src in present else F.lit(None).cast("string")
        cols.append(safe_text(c).alias(dst))
    return cols


def _csv(spark: SparkSession, files: list[str], multi_line: bool | None, names: list[str], header: bool,
         split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """CSV files of one layout as text columns ``names``."""
    if multi_line is None:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
        odd = (spark.read.text(list(files)).where(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("path")).distinct())
        broken = {_plain(r.path) for r in odd.collect()}  # names out of ``files``
        parts = [([f for f in files if (_plain(f) in broken) == cut], cut) for cut in (False, True)]
    else:
        parts = [(list(files), multi_line)]
    frames = []
    for own, cut in parts:
        if own and cut:
            frames.append(read_split_csv(spark, own, names, header, CSV_OPTIONS, split_bytes))
        elif own:
            reader = spark.read.options(**CSV_OPTIONS).option("header", header).option("enforceSchema", "true")
            frames.append(reader.schema(", ".join(f"c{i} string" for i in range(len(names)))).csv(own).toDF(*names))
    return reduce(DataFrame.unionByName, frames)


def _header_names(line: str) -> list[str]:
    """Column names of a header line, trimmed; a repeated or empty name gets its place."""
    cells = [c.strip() for c in next(csv.reader([line.lstrip("\ufeff")]), [])]
    seen: set[str] = set()
    out = []
    for i, c in enumerate(cells):
        name = c if c and c.lower() not in seen else f"{c}#{i}"
        seen.add(name.lower())
        out.append(name)
    return out


def _plain(path: str) -> str:
    """One spelling of a file's path, whether it comes from a listing or from a row."""
    return unquote(path.replace("file:///", "file:/"))


def _empty_flows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} string" for c in FLOW_FIELDS))


def read_cicflow_csv(spark: SparkSession, files: list[str], multi_line: bool | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """CICFlowMeter CSV files with a header row -> the 12 flow fields."""
    if not files:
        return _empty_flows(spark)
    frames = []
    for head, group in group_by_first_line(spark, qualified(spark, files)).items():
        names = _header_names(head)
        if names:  # else empty files
            frames.append(_csv(spark, group, multi_line, names, True, split_bytes).select(*_pick_cols(CICFLOW_COLUMN_MAP, set(names))))
    if not frames:
        return _empty_flows(spark)
    return _union(frames).select(*FLOW_FIELDS)


def _has_unsw_header(line: str) -> bool:
    first = line.strip().lower()
    return first.startswith("srcip") or first.startswith('"srcip')


def read_unsw_csv(spark: SparkSession, files: list[str], multi_line: bool | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """S3: UNSW-NB15 files, headerless (49 fixed names) or with a header
    (names trimmed, lower-cased) -> the flow fields; the label falls back
    to the 0/1 ``label`` column when ``attack_cat`` is empty (P4)."""
    if not files:
        return _empty_flows(spark)
    frames = []
    # all headerless files are one group, whatever their first row
    key = lambda line: line if _has_unsw_header(line) else None
    for head, group in group_by_first_line(spark, qualified(spark, files), key).items():
        names = list(UNSW_SCHEMA.fieldNames()) if head is None else [c.lower() for c in _header_names(head)]
        df = _csv(spark, group, multi_line, names, head is not None, split_bytes)
        present = set(names)
        binary = safe_text(F.coalesce(F.col("label"), F.lit(""))) if "label" in present else F.lit("")
        picked = df.select(*_pick_cols(UNSW_COLUMN_MAP, present), binary.alias("_binary_label"))
        frames.append(
            picked.withColumn("label", label_fallback(F.col("label"), F.col("_binary_label")))
            .drop("_binary_label")
        )
    out = _union(frames)
    for c in FLOW_FIELDS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*FLOW_FIELDS)


def as_raw_messages(flows: DataFrame, dataset_source: str,
                    produced_at: Column | None = None) -> DataFrame:
    """P5: tag rows with their dataset and the producer clock in epoch
    millis (``produced_at`` overrides the clock) -> RAW_SCHEMA columns."""
    ts = produced_at if produced_at is not None else F.unix_millis(F.current_timestamp())
    return flows.select(*FLOW_FIELDS, F.lit(dataset_source).alias("dataset_source"),
                        ts.cast("bigint").alias("produced_at_ts"))
