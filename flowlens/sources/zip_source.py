"""Zipped CSV source.

A zip is not splittable, so each file is one task. The first ``.csv``
member is decoded as UTF-8 with bad bytes replaced, its header names are
trimmed, and each row yields the mapped columns as text (``''`` for an
empty or missing cell, NULL for a column the file lacks). Blank lines are no
rows; cells may hold line breaks and be of any length.

A Python Data Source streams the member from wherever the file lies
(``flowlens.sources.files.open_input``); no archive is loaded whole.
"""

from __future__ import annotations

import csv
import io
import json
import sys
import zipfile
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from flowlens.functions.sanitize import safe_text
from flowlens.schemas import CICFLOW_COLUMN_MAP, FLOW_FIELDS
from flowlens.sources.files import open_input, qualified

# The source runs in Python workers (planning and reading). Its classes are
# sent by value, so the workers need only pyspark and pyarrow, not this
# package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The longest cell a reader accepts; Python's own default is 131,072 characters.
LONGEST_CELL = 2**31 - 1


class _ZipFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _ZipCsvReader(DataSourceReader):
    def __init__(self, paths: list[str], mapping: dict):
        self.paths = paths
        self.mapping = mapping

    def partitions(self):
        return [_ZipFile(p) for p in self.paths]

    def read(self, partition):
        with open_input(partition.path) as fh:
            yield from zip_rows(fh, self.mapping)


def csv_records(lines) -> Iterator[list[str]]:
    """Records of a text stream, without those of blank lines."""
    csv.field_size_limit(LONGEST_CELL)
    for cells in csv.reader(lines):
        if len(cells) > 1 or (cells and (not cells[0] or cells[0].strip())):
            yield cells


def zip_rows(fileobj, mapping: dict):
    """Rows of the first ``.csv`` member of a zip, in the order of ``mapping``
    (absent column: NULL; a short row's missing cells: '', as pandas reads
    them)."""
    archive = zipfile.ZipFile(fileobj)
    names = [n for n in archive.namelist() if n[-4:].lower() == ".csv"]
    if not names:
        return
    with archive.open(names[0]) as member:
        records = csv_records(io.TextIOWrapper(member, encoding="utf-8", errors="replace", newline=""))
        place: dict[str, int] = {}
        for i, name in enumerate(next(records, [])):
            place.setdefault(name.strip(), i)
        wanted = [place.get(source) for source in mapping]
        for cells in records:
            yield tuple(None if i is None else cells[i] if i < len(cells) else "" for i in wanted)


class ZipCsvDataSource(DataSource):
    """``spark.read.format("zipcsv").option("paths", json_list).load()``."""

    @classmethod
    def name(cls):
        return "zipcsv"

    def _mapping(self) -> dict:
        return json.loads(self.options.get("mapping", json.dumps(CICFLOW_COLUMN_MAP)))

    def schema(self):
        return ", ".join(f"`{dst}` string" for dst in self._mapping().values())

    def reader(self, schema):
        return _ZipCsvReader(json.loads(self.options["paths"]), self._mapping())


def read_zip_csv(spark: SparkSession, files: list[str], mapping: dict = CICFLOW_COLUMN_MAP) -> DataFrame:
    """Zipped CICFlowMeter CSV files -> the flow fields, NaN/infinity
    text to NULL (P3)."""
    spark.dataSource.register(ZipCsvDataSource)
    df = (spark.read.format("zipcsv").option("paths", json.dumps(qualified(spark, files)))
          .option("mapping", json.dumps(mapping)).load())
    out = df.select(*[safe_text(df[c]).alias(c) for c in df.columns])
    for c in FLOW_FIELDS:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*FLOW_FIELDS)
