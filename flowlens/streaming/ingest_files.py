"""Ingest with a ledger of files (J5): each dataset file is published once.

A discovery stream follows the data root; its checkpoint is the ledger of the
files that have been taken in. A micro-batch is a list of new files: they are
read as ``plans.jobs`` reads them (each bound by its own header) and published.
Only file names reach the driver, and only new ones.

A file sink gets one folder a batch, which a batch that is run again replaces,
so a row is there once. A Kafka sink gets the rows of a batch that failed half
way once more (at least once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flowlens.plans.jobs import publish_messages, read_files
from flowlens.sources.files import sort_dataset_files
from flowlens.streaming.jobs import start_query

# The columns of Spark's binary file source.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_ingest(spark: SparkSession, root: str, checkpoint: str, fmt: str = "kafka", path: str | None = None, options: dict | None = None,
                 produced_at: Column | None = None, trigger: dict | None = None, max_files: int | None = None) -> StreamingQuery:
    """Publish the dataset files under ``root`` that the checkpoint does not
    know yet: those there now (``availableNow``), or as they come."""
    # age is no reason to leave a file out: files are copied with old times
    found = (spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{csv,CSV,zip,ZIP}")
             .option("maxFileAge", "36500d"))
    if max_files:
        found = found.option("maxFilesPerTrigger", str(max_files))
    paths = found.load(root).select("path")  # the content is not read here

    def publish(batch: DataFrame, batch_id: int) -> None:
        files = sort_dataset_files([r.path for r in batch.collect()])
        if any(files.values()):
            target = None if path is None else f"{path.rstrip('/')}/batch_id={int(batch_id)}"
            publish_messages(read_files(spark, files, produced_at), fmt, target, options, mode="overwrite")

    return start_query(paths.writeStream.foreachBatch(publish), checkpoint, trigger, None)
