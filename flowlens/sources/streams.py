"""Message stream sources.

The jobs read (key, value, topic) messages. In production that is Kafka;
the format is a parameter, so the same jobs run over a folder of JSON
lines (``format="text"``) in tests and backfills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BROKERS = "localhost:9092"
RAW_TOPICS = "raw-cicids,raw-unsw,raw-cicdos"
NORMALIZED_TOPIC = "logs-normalized"
ALERT_TOPIC = "logs-alerts"
LEGACY_TOPIC = "raw-cicids"


def stream_source(
    spark: SparkSession,
    fmt: str = "kafka",
    topics: str = RAW_TOPICS,
    brokers: str = DEFAULT_BROKERS,
    path: str | None = None,
    fail_on_data_loss: bool | None = False,
    options: dict | None = None,
) -> DataFrame:
    """A message stream with ``value`` (and ``key``/``topic`` when the
    source has them), read from the earliest offset.

    ``fail_on_data_loss=None`` leaves Kafka's default (the legacy job).
    File formats read ``path``; each line is one message value.
    """
    options = dict(options or {})
    if fmt == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topics)
            .option("startingOffsets", "earliest")
        )
        if fail_on_data_loss is not None:
            reader = reader.option("failOnDataLoss", str(bool(fail_on_data_loss)).lower())
        return reader.options(**options).load()
    if path is None:
        raise ValueError("a file stream needs a path")
    df = spark.readStream.format(fmt).options(**options).load(path)
    if "topic" not in df.columns:
        df = df.withColumn("topic", F.lit(None).cast("string"))
    return df
