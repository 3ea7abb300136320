"""Raw messages -> unified rows (Job 1's projection: P6, P10-P13, P15).

One narrow projection: no shuffle, no Python, batch and stream alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowlens.functions.classify import with_category
from flowlens.functions.sanitize import (
    DOUBLE_PAD,
    LONG_PAD,
    to_double_sql,
    to_long_sql,
    trimmed_sql,
)
from flowlens.schemas import DOUBLE_FIELDS, FLOW_FIELDS, LONG_FIELDS, NORMALIZED_COLUMNS, RAW_SCHEMA


def decode_json(df: DataFrame, schema=RAW_SCHEMA, value_col: str = "value", keep=()) -> DataFrame:
    """Binary or text JSON messages -> flat columns.

    A malformed message gives an all-NULL row, as ``from_json`` does in
    permissive mode. ``keep`` names columns carried along (e.g. ``topic``).
    """
    parsed = df.select(
        F.from_json(F.col(value_col).cast("string"), schema).alias("d"), *keep
    )
    return parsed.select("d.*", *keep)


def malformed_json(df: DataFrame, schema=RAW_SCHEMA, value_col: str = "value", keep=()) -> DataFrame:
    """The messages that ``decode_json`` turns into all-NULL rows, as they
    came (``value``), for a side table. A NULL message counts as malformed."""
    text = F.col(value_col).cast("string")
    corrupt = StructType([*schema.fields, StructField("_corrupt", StringType())])
    parsed = df.select(text.alias("value"), F.from_json(text, corrupt, {"columnNameOfCorruptRecord": "_corrupt"}).alias("d"), *keep)
    return parsed.where(F.col("d").isNull() | F.col("d._corrupt").isNotNull()).select("value", *keep)


def normalize(raw: DataFrame, event_time: str | Column | None = None) -> DataFrame:
    """Enrich and type raw rows.

    ``event_time`` is the time column to stamp rows with; by default the
    processing clock ``current_timestamp()``, as the streaming job does. A
    named column is used and then dropped. ``partition_date`` is its day.
    """
    if event_time is None:
        ts = F.current_timestamp()
    elif isinstance(event_time, str):
        ts = F.col(event_time).cast("timestamp")
    else:
        ts = event_time.cast("timestamp")

    # stage 1: each numeric cell trimmed once (the casts test it several times)
    numeric = LONG_FIELDS + DOUBLE_FIELDS
    staged = raw.select(
        *FLOW_FIELDS, "dataset_source", "produced_at_ts", ts.alias("event_timestamp"),
        *[F.expr(trimmed_sql(f"`{n}`", LONG_PAD if n in LONG_FIELDS else DOUBLE_PAD))
          .alias(f"__t_{n}") for n in numeric],
    )
    # stage 2: the casts
    out = []
    for name in FLOW_FIELDS:
        if name in LONG_FIELDS:
            out.append(F.expr(to_long_sql(f"`{name}`", f"`__t_{name}`")).alias(name))
        elif name in DOUBLE_FIELDS:
            out.append(F.expr(to_double_sql(f"`{name}`", f"`__t_{name}`")).alias(name))
        else:
            out.append(F.col(name))
    typed = staged.select(*out, "dataset_source", "produced_at_ts", "event_timestamp")
    # stage 3: category and severity; partition_date from the same time stamp
    return (
        with_category(typed)
        .withColumn("partition_date", F.date_format(F.col("event_timestamp"), "yyyy-MM-dd"))
        .select(*NORMALIZED_COLUMNS)
    )
