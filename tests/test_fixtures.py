"""Files and messages written from ``events``: the bytes of Python's CSV writer, by as many tasks as there are cores."""

import csv
import glob
import io

import pytest
from pyspark.sql import functions as F

from flowlens.plans import fixtures
from flowlens.plans import source_queries
from flowlens.session import default_parallelism
from tests.conftest import SF_SMALL
from tests.test_sources import _local

CELLS = ["", None, " ", "a", "a,b", 'say "x"', '"', "two\nlines", "cr\rhere", "é日", ",", "x" * 70_000 + "\n"]


@pytest.mark.parametrize("width", [1, 3])
def test_lines_are_those_of_the_csv_writer(spark, width):
    rows = [[CELLS[(i + 5 * j) % len(CELLS)] for j in range(width)] for i in range(len(CELLS))]
    frame = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"c{j} string" for j in range(width))).coalesce(1)
    want = []
    for r in rows:
        text = io.StringIO(newline="")
        csv.writer(text, lineterminator="\n").writerow(r)
        want.append(text.getvalue())
    assert [r.line for r in fixtures.csv_lines(frame).collect()] == want


def test_file_holds_header_lines_and_blank_lines(spark, workdir):
    frame = spark.createDataFrame([("1", 'a"b'), ("2", "c\nd")], "c0 string, c1 string").coalesce(1)
    fixtures.write_files(frame, f"{workdir}/f", "x_", ["h,1", "h2"])
    with open(_local(f"{workdir}/f/x_0.csv"), "rb") as f:
        assert f.read() == b'"h,1",h2\n1,"a""b"\n2,"c\nd"\n\n  \n'


def test_a_table_of_one_row_group_is_written_by_all_cores(spark, workdir):
    raw, first_half = source_queries._raw(spark, SF_SMALL)
    source_queries._write_unsw(raw, first_half, workdir)
    files = glob.glob(f"{_local(workdir)}/UNSW-NB15/UNSW-NB15_h*.csv")
    assert len(files) == default_parallelism(spark) > 1
    assert raw.select(F.spark_partition_id()).distinct().count() == default_parallelism(spark)


def test_every_dataset_is_written_by_all_cores(spark, workdir):
    """publish_payload's datasets in both layouts, from a table of one row group."""
    raw, first_half = source_queries._raw(spark, SF_SMALL)
    source_queries._write_cic(raw.filter(F.col("dataset_source") != "unsw"), first_half, workdir)
    for folder in [source_queries.CICIDS_DIR, *source_queries.CICDOS_DIRS]:
        assert len(glob.glob(f"{_local(workdir)}/{folder}/*.csv")) == default_parallelism(spark) > 1
