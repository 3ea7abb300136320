"""The streaming jobs (J1, J2, J4, J6) on Structured Streaming.

* J1 ``start_normalizer``: messages -> unified rows -> partitioned table, by
  the exactly-once Parquet file sink; ``start_forward`` follows that table
  and forwards its new rows as messages, so both hold the same rows.
* J2 ``start_window_table``: event-time tumbling windows under a watermark,
  append mode, so each window is written once, when it closes, by the
  exactly-once Parquet file sink.
* J2 ``start_table_alerts``: follows the window table and sends the alert
  messages of closed windows; no second aggregate.
* J2 ``start_alert_stream``: the same aggregate in update mode, for alerts
  that must leave as soon as a window crosses a threshold; every updated
  window is also kept with its ``batch_id`` so readers can take the newest
  version. It reads, shuffles and keeps state a second time.
* J4 ``start_archive``: legacy messages to a date-partitioned Parquet sink.
* J6 ``start_alert_text``: alert messages to formatted text.

Triggers default to the 30-second processing-time trigger; pass
``{"availableNow": True}`` for tests and backfills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowlens.functions.payload import alert_text_from_json, forward_payload
from flowlens.operators.normalize import decode_json, malformed_json, normalize
from flowlens.operators.windows import (
    DEFAULT_EVENTS_THRESHOLD,
    DEFAULT_KEYS,
    DEFAULT_SYN_THRESHOLD,
    DEFAULT_WIDTH,
    alerts,
    window_metrics,
)
from flowlens.schemas import (
    LEGACY_SCHEMA,
    NORMALIZED_PARTITIONS,
    NORMALIZED_SCHEMA,
    RAW_SCHEMA,
    UNIFIED_SCHEMA,
    WINDOW_PARTITIONS,
    WINDOW_SCHEMA,
)
from flowlens.sinks.writers import write_batch_partitioned, write_keyed

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}
# The alert history is partitioned by window day (then batch), so readers of
# recent alerts prune it by date instead of reading every update ever made.
UPDATE_PARTITIONS = ["window_start_date"]
DEFAULT_WATERMARK = "2 minutes"


def start_query(writer, checkpoint: str, trigger: dict | None, name: str | None,
           df: DataFrame | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start a query. ``state_partitions`` fixes the shuffle (and state
    store) partitions of a new query; a restarted query keeps the number
    recorded in its checkpoint. The session setting is restored after the
    start (the running query works on its own copy of the session)."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or DEFAULT_TRIGGER))
    if name:
        writer = writer.queryName(name)
    if state_partitions is None or df is None:
        return writer.start()
    conf = df.sparkSession.conf
    old = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    try:
        return writer.start()
    finally:
        conf.set("spark.sql.shuffle.partitions", old)


def normalized_stream(messages: DataFrame, event_time: Column | str | None = None) -> DataFrame:
    """J1's plan: decode raw messages (P6) and normalise them."""
    return normalize(decode_json(messages, RAW_SCHEMA, keep=("topic",)), event_time=event_time)


def start_normalizer(
    messages: DataFrame,
    table_path: str,
    checkpoint: str,
    event_time: Column | str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """J1's table (K1), partitioned by ``attack_category`` and
    ``partition_date``. The sink's log makes each micro-batch visible once and
    whole, so a batch run again after a failure adds nothing, and no folder
    level is needed a batch."""
    norm = normalized_stream(messages, event_time)
    writer = norm.writeStream.format("parquet").partitionBy(*NORMALIZED_PARTITIONS).option("path", table_path)
    return start_query(writer, checkpoint, trigger, name)


def follow_table(spark: SparkSession, table_path: str, schema) -> DataFrame:
    """New rows of a table that a file sink writes, as a stream. The folder is
    made where the sink has not written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return spark.readStream.schema(schema).parquet(table_path)


def _finish_backfill(query: StreamingQuery, trigger: dict | None) -> None:
    """Before a follower starts: an ``availableNow`` run must have written its table."""
    if trigger and trigger.get("availableNow"):
        query.awaitTermination()


def _start_messages(rows: DataFrame, sink: dict, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    """Send rows as keyed messages; ``sink`` holds ``write_keyed`` arguments."""
    def process(batch: DataFrame, batch_id: int) -> None:
        write_keyed(batch, batch_id=batch_id, **sink)

    return start_query(forward_payload(rows).writeStream.foreachBatch(process), checkpoint, trigger, name)


def start_forward(spark: SparkSession, table_path: str, checkpoint: str, sink: dict,
                  trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """J1's forwarded messages (K2): the normalised table's new rows."""
    return _start_messages(follow_table(spark, table_path, NORMALIZED_SCHEMA), sink, checkpoint, trigger, name)


def start_quarantine(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                     name: str | None = None) -> StreamingQuery:
    """Raw messages that do not parse, kept as they came, by topic and arrival
    time; the normalised table holds an all-NULL ``Unknown`` row for each."""
    rows = malformed_json(messages, RAW_SCHEMA, keep=("topic",)).withColumn("seen_at", F.current_timestamp())
    return start_query(rows.writeStream.format("parquet").option("path", path), checkpoint, trigger, name)


def start_normalizer_and_forward(messages: DataFrame, table_path: str, checkpoint_root: str, sink: dict | None,
                                 event_time: Column | str | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    """J1 whole: the table and, with a ``sink``, its forwarded messages."""
    root = checkpoint_root.rstrip("/")
    out = [start_normalizer(messages, table_path, f"{root}/table", event_time, trigger)]
    if sink:
        _finish_backfill(out[0], trigger)
        out.append(start_forward(messages.sparkSession, table_path, f"{root}/forward", sink, trigger))
    return out


def start_table_alerts(spark: SparkSession, table_path: str, checkpoint: str, sink: dict,
                       trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """J2's alert messages (K4) from the window table: one message a closed alert window."""
    return _start_messages(alerts(follow_table(spark, table_path, WINDOW_SCHEMA)), sink, checkpoint, trigger, name)


def window_stream(
    messages: DataFrame,
    width: str = DEFAULT_WIDTH,
    events_threshold: int = DEFAULT_EVENTS_THRESHOLD,
    syn_threshold: float = DEFAULT_SYN_THRESHOLD,
    watermark: str = DEFAULT_WATERMARK,
    distinct: str = "set",
    keys=DEFAULT_KEYS,
) -> DataFrame:
    """J2's plan: decode unified rows (P7), watermark (T1), window.
    ``keys`` are the grouping columns besides the window (D6: e.g.
    ``("dst_port", "dataset_source")``)."""
    return window_flows(decode_json(messages, UNIFIED_SCHEMA), width, events_threshold, syn_threshold, watermark, distinct, keys)


def window_flows(
    rows: DataFrame,
    width: str = DEFAULT_WIDTH,
    events_threshold: int = DEFAULT_EVENTS_THRESHOLD,
    syn_threshold: float = DEFAULT_SYN_THRESHOLD,
    watermark: str = DEFAULT_WATERMARK,
    distinct: str = "set",
    keys=DEFAULT_KEYS,
) -> DataFrame:
    """``window_stream`` over unified rows (for instance those that are on time)."""
    flows = rows.withWatermark("event_timestamp", watermark)
    return window_metrics(flows, width=width, keys=keys, events_threshold=events_threshold,
                          syn_threshold=syn_threshold, distinct=distinct)


def start_window_table(
    messages: DataFrame,
    table_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
    **window_args,
) -> StreamingQuery:
    """J2, table half (K3): append mode; one final row per closed window. A
    stream without a message column is taken as unified rows."""
    windows = (window_stream if "value" in messages.columns else window_flows)(messages, **window_args)
    writer = (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*WINDOW_PARTITIONS)
        .option("path", table_path)
    )
    return start_query(writer, checkpoint, trigger, name, windows, state_partitions)


def start_alert_stream(
    messages: DataFrame,
    updates_path: str,
    checkpoint: str,
    alert_sink: dict | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    state_partitions: int | None = None,
    **window_args,
) -> StreamingQuery:
    """J2, alert half (T3, K4): update mode. Every updated window goes to
    ``updates_path`` under its window day and ``batch_id``; alert rows also
    go to ``alert_sink`` (``write_keyed`` arguments), skipped when there are
    none.
    """
    windows = window_stream(messages, **window_args)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            write_batch_partitioned(batch, updates_path, UPDATE_PARTITIONS, batch_id)
            hits = alerts(batch)
            if alert_sink and not hits.isEmpty():
                write_keyed(forward_payload(hits), batch_id=batch_id, **alert_sink)
        finally:
            batch.unpersist()

    writer = windows.writeStream.outputMode("update").foreachBatch(process)
    return start_query(writer, checkpoint, trigger, name, windows, state_partitions)


def start_aggregator(messages: DataFrame, table_path: str, checkpoint_root: str, alert_sink: dict | None = None,
                     updates_path: str | None = None, trigger: dict | None = None,
                     state_partitions: int | None = None, **window_args) -> list[StreamingQuery]:
    """The window table and its alerts.

    Alerts follow the table, unless ``updates_path`` asks for early ones from
    an update-mode aggregate of its own. Without an alert sink only the table
    (and the update history) is written.
    """
    root = checkpoint_root.rstrip("/")
    out = [start_window_table(messages, table_path, f"{root}/windows", trigger,
                              state_partitions=state_partitions, **window_args)]
    if updates_path:
        out.append(start_alert_stream(messages, updates_path, f"{root}/alerts", alert_sink, trigger,
                                      state_partitions=state_partitions, **window_args))
    elif alert_sink:
        _finish_backfill(out[0], trigger)
        out.append(start_table_alerts(messages.sparkSession, table_path, f"{root}/alerts", alert_sink, trigger))
    return out


def archive_stream(messages: DataFrame, schema=LEGACY_SCHEMA) -> DataFrame:
    """J4's plan: decode with ``schema`` and stamp ``processed_at``."""
    return decode_json(messages, schema).withColumn("processed_at", F.current_timestamp())


def start_archive(messages: DataFrame, table_path: str, checkpoint: str,
                  schema=LEGACY_SCHEMA, trigger: dict | None = None,
                  name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """J4 (K5): native Parquet sink partitioned by ``partition_date``."""
    writer = (
        archive_stream(messages, schema).writeStream.format("parquet")
        .partitionBy("partition_date")
        .option("path", table_path)
    )
    return start_query(writer, checkpoint, trigger, name, messages, state_partitions)


def start_alert_text(messages: DataFrame, checkpoint: str, fmt: str = "console",
                     path: str | None = None, trigger: dict | None = None,
                     name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """J6 (K8): alert messages to text.

    ``fmt="print"`` prints each alert's text as it is (a ``foreach`` writer,
    so every task prints its own rows; nothing is gathered on the driver);
    ``"console"`` shows the untruncated column; a file format writes to
    ``path``.
    """
    texts = alert_text_from_json(messages)
    if fmt == "print":
        writer = texts.writeStream.foreach(_print_alert)
    else:
        writer = texts.writeStream.format(fmt)
        if fmt == "console":
            writer = writer.option("truncate", "false")
        if path:
            writer = writer.option("path", path)
    return start_query(writer, checkpoint, trigger, name, messages, state_partitions)


def _print_alert(row) -> None:
    print(row["alert_text"], flush=True)


class LateInputCounter(StreamingQueryListener):
    """What stateful queries drop behind their watermark, in total.

    The unit is the operator's input row. In a windowed aggregate that is a
    partially aggregated group (late rows of one key, window and task count
    once), not a message. Spark keeps no side output of them, and a query's
    own progress reports only reach back ``spark.sql.streaming.numRecentProgressUpdates``
    batches; the listener adds them up as they come.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        key = str(event.progress.id)
        late = sum(op.numRowsDroppedByWatermark or 0 for op in event.progress.stateOperators)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def count_late_input(spark: SparkSession) -> LateInputCounter:
    """A counter of all queries started from now on."""
    counter = LateInputCounter()
    spark.streams.addListener(counter)
    return counter
