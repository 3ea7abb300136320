import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("flowlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from flowlens.session import shared_dir

    shared_dir(s)  # the configured spark.checkpoint.dir; a temporary one only when unset
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tests.compare import duck

    return duck(SF_SMALL)


@pytest.fixture()
def workdir(spark):
    from flowlens.session import new_work_dir

    return new_work_dir(spark, "test")
