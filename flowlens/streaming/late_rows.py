"""Late rows kept in a table of their own.

Spark's stateful operators drop what is behind their watermark and only count
partial groups. ``start_gate`` decides ahead of them, row by row, by the same
rule: in batch ``n`` the watermark is the latest event time of the batches
before ``n`` less the delay, and a row is late if its window has ended by then.
The rows go to ``<root>/rows``, partitioned by ``late`` and batch; what later
batches need (the latest event time) and the totals are committed with the
batch's number (``sinks.versions``), so they survive a restart, and a batch that
is run again is decided by the same watermark and counted once.

``kept_rows`` follows the rows that are on time. A window aggregate over them
with the same delay drops nothing: its watermark comes from kept rows of
earlier batches, so it is never ahead of the gate's. Rows without an event time
belong to no window; they are kept with the late ones, told apart by
``late_reason``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.normalize import decode_json
from flowlens.operators.windows import DEFAULT_WIDTH
from flowlens.schemas import UNIFIED_SCHEMA, with_fields
from flowlens.sinks.versions import Version, Versions
from flowlens.sinks.writers import write_batch_partitioned
from flowlens.streaming.jobs import DEFAULT_WATERMARK, follow_table, start_query


@dataclass(frozen=True)
class GateTotals:
    """Rows so far, and the latest event time (microseconds) that they hold."""

    kept: int = 0
    late: int = 0
    without_time: int = 0
    latest: int | None = None


def gate_totals(spark: SparkSession, root: str) -> GateTotals:
    """The totals of all committed batches."""
    return _totals(Versions(spark, root).current())


def _totals(version: Version) -> GateTotals:
    return GateTotals(**version.segments[0]["totals"]) if version.segments else GateTotals()


def late_reason(latest: int | None, width: str, delay: str, time_col: str = "event_timestamp") -> Column:
    """``BEHIND_WATERMARK`` or ``NO_EVENT_TIME``, else null. ``latest`` is the
    latest event time of the batches before."""
    no_time = F.when(F.col(time_col).isNull(), F.lit("NO_EVENT_TIME"))
    if latest is None:
        return no_time
    # tumbling windows are counted from the epoch; F.window itself would drop rows without a time
    at, size = F.unix_micros(time_col), _micros(width)
    return no_time.when(at - F.pmod(at, size) + size <= F.lit(latest) - _micros(delay), F.lit("BEHIND_WATERMARK"))


def _micros(interval: str) -> Column:
    """A day-time interval in microseconds."""
    return F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")


def gate_batch(batch: DataFrame, batch_id: int, store: Versions, width: str, delay: str) -> None:
    """Deal one batch's rows and commit its totals, once."""
    now = store.current()
    if now.mark is not None and now.mark >= batch_id:
        return
    before = _totals(now)
    reason = F.col("late_reason")
    dealt = batch.withColumn("late_reason", late_reason(before.latest, width, delay)).withColumn("late", reason.isNotNull())
    write_batch_partitioned(dealt, f"{store.root}/rows", ["late"], batch_id)
    found = _written(store, int(batch_id)).agg(
        F.count_if(reason.isNull()).alias("kept"), F.count_if(reason == "BEHIND_WATERMARK").alias("late"),
        F.count_if(reason == "NO_EVENT_TIME").alias("without_time"), F.max(F.unix_micros("event_timestamp")).alias("latest")).first()
    latest = [t for t in (before.latest, found["latest"]) if t is not None]
    totals = {"kept": before.kept + found["kept"], "late": before.late + found["late"],
              "without_time": before.without_time + found["without_time"], "latest": max(latest, default=None)}
    store.commit(now, [{"path": f"{store.root}/rows", "totals": totals}], int(batch_id))


def _written(store: Versions, batch_id: int) -> DataFrame:
    """One batch's rows as they were written: two columns of the table are read,
    while the batch itself would be read and decoded once more."""
    folders = [f"{store.root}/{_rows(late)}/batch_id={batch_id}" for late in (False, True)]
    found = [f for f in folders if store.has(f)]
    schema = "event_timestamp timestamp, late_reason string"
    return store.spark.read.schema(schema).parquet(*found) if found else store.spark.createDataFrame([], schema)


def start_gate(messages: DataFrame, root: str, checkpoint: str, width: str = DEFAULT_WIDTH, watermark: str = DEFAULT_WATERMARK,
               trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Unified messages (P7) dealt into rows on time and late ones under ``root``."""
    store = Versions(messages.sparkSession, root)
    rows = decode_json(messages, UNIFIED_SCHEMA)
    writer = rows.writeStream.foreachBatch(lambda batch, batch_id: gate_batch(batch, batch_id, store, width, watermark))
    return start_query(writer, checkpoint, trigger, name)


def _rows(late: bool) -> str:
    return f"rows/late={str(late).lower()}"


def kept_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows on time, as a stream."""
    return follow_table(spark, f"{root.rstrip('/')}/{_rows(False)}", UNIFIED_SCHEMA).select(*UNIFIED_SCHEMA.fieldNames())


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """The side table: late rows with their reason and batch."""
    schema = with_fields(UNIFIED_SCHEMA, ("late_reason", "string"), ("batch_id", "bigint"))
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{_rows(True)}")
