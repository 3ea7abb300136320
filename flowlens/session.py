"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowlens") -> SparkSession:
    """A local session with the settings the library expects (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local master may leave it
    unset: then a temporary folder is made and set, so that
    ``DataFrame.checkpoint`` works too. On a cluster such a folder would be
    another one on every machine, so there an unset folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    d = tempfile.mkdtemp(prefix="flowlens-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir()


def default_parallelism(spark: SparkSession) -> int:
    """Cores of the application, or the shuffle partitions when the session
    has no SparkContext (a remote session)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one run; writers make the folders."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
