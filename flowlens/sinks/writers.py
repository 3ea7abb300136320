"""Sinks (K1-K5, K7, K8).

Table writes are retry-safe: a micro-batch is written under its own
``batch_id`` partition with dynamic partition overwrite, so a batch that
is run again after an executor or driver failure replaces its own files
instead of adding a second copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clustered(df: DataFrame, partition_cols) -> DataFrame:
    """Rows grouped by the table's partition columns before a partitioned
    write, so each directory gets few files. ``rebalance`` lets AQE split a
    directory that holds a large share of the rows over several tasks and
    merge small ones, so one hot category never lands in a single task."""
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def refuse_sink_table(df: DataFrame, path: str) -> None:
    """A folder that a streaming file sink writes is read through the sink's
    log: files written beside it are never seen, and overwriting it removes the
    log or leaves it naming files that are gone. See ``sinks.compaction``."""
    spark = df.sparkSession
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} is the table of a streaming file sink; batch jobs must not write there")


def write_partitioned(df: DataFrame, path: str, partition_cols, mode: str = "overwrite",
                      fmt: str = "parquet") -> None:
    """K1/K3 in batch: a table partitioned by ``partition_cols``."""
    refuse_sink_table(df, path)
    clustered(df, partition_cols).write.mode(mode).partitionBy(*partition_cols).format(fmt).save(path)


def write_batch_partitioned(df: DataFrame, path: str, partition_cols, batch_id: int,
                            fmt: str = "parquet") -> None:
    """K1/K3 from ``foreachBatch``: append one micro-batch, idempotently."""
    refuse_sink_table(df, path)
    (
        clustered(df, partition_cols)
        .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols, "batch_id")
        .format(fmt)
        .save(path)
    )


def write_keyed(payload: DataFrame, fmt: str = "kafka", path: str | None = None,
                topic: str | None = None, options: dict | None = None,
                batch_id: int | None = None) -> None:
    """K2/K4/K7: write (key, value) messages.

    ``fmt="kafka"`` sends to ``topic`` (options carry the brokers); any file
    format writes the pair to ``path`` (one folder per batch when
    ``batch_id`` is given, so a re-run batch overwrites itself).
    """
    options = dict(options or {})
    if fmt == "kafka":
        w = payload.write.format("kafka").options(**options)
        if topic:
            w = w.option("topic", topic)
        w.save()
        return
    if path is None:
        raise ValueError("a file sink needs a path")
    target = path if batch_id is None else f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    mode = "append" if batch_id is None else "overwrite"
    payload.write.mode(mode).format(fmt).options(**options).save(target)

