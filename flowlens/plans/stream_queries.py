"""Registered streaming checks: the jobs run over ``events`` delivered as
message files in steps, each step a restart of the query from its
checkpoint with ``availableNow``; the result is read back from the sink.

Steps split ``events`` by day: the first half of the days, then the rest
(in order); for the late-data check the middle, then the end, then the
start, which arrives behind the watermark and is dropped whole.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.payload import alert_text_from_json, forward_payload, publish_payload
from flowlens.operators.normalize import decode_json, normalize
from flowlens.operators.windows import alerts, latest_per_window, window_metrics
from flowlens.plans.batch_queries import ALERT_EVENTS_THRESHOLD, ALERT_WIDTH, day_windows, rounded
from flowlens.plans.layout import REPORTS, layout_columns
from flowlens.schemas import (
    LEGACY_SCHEMA,
    NORMALIZED_COLUMNS,
    NORMALIZED_SCHEMA,
    UNIFIED_SCHEMA,
    WINDOW_PARTITIONS,
    WINDOW_SCHEMA,
    with_fields,
)
from flowlens.sinks.compaction import compact, publish_view
from flowlens.sinks.reports import read_report
from flowlens.session import default_parallelism, new_work_dir
from flowlens.sources.events_adapter import dealt_out, load_events, raw_flows
from flowlens.sources.streams import stream_source
from flowlens.sources.tables import refresh_tables, register_tables, register_views
from flowlens.streaming import jobs
from flowlens.streaming.late_rows import gate_totals, kept_rows, start_gate
from flowlens.streaming.report_state import update_reports

AVAILABLE_NOW = {"availableNow": True}


def _state_partitions(spark: SparkSession) -> int:
    """State partitions of the check streams: one per core."""
    return default_parallelism(spark)


def day_splits(events: DataFrame):
    """(first day, middle day, three-quarter day) of ``events`` as dates."""
    row = events.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    n = (hi - lo).days + 1
    return lo, lo + dt.timedelta(days=n // 2), lo + dt.timedelta(days=(3 * n) // 4)


def _day_ts(d) -> F.Column:
    return F.lit(d.isoformat()).cast("timestamp")


def in_order_steps(events: DataFrame):
    _, mid, _ = day_splits(events)
    ts = F.col("ts").cast("timestamp")
    return [ts < _day_ts(mid), ts >= _day_ts(mid)]


def late_steps(events: DataFrame):
    _, mid, q3 = day_splits(events)
    ts = F.col("ts").cast("timestamp")
    return [(ts >= _day_ts(mid)) & (ts < _day_ts(q3)), ts >= _day_ts(q3), ts < _day_ts(mid)]


def run_steps(events: DataFrame, steps, to_messages, start, src: str) -> None:
    """Write each step's messages as a new folder of JSON lines under
    ``src``, then run ``start()`` (a query reading ``src``) to completion."""
    for i, cond in enumerate(steps):
        to_messages(dealt_out(events.filter(cond))).select("value").write.text(f"{src}/step{i}")
        q = start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()


def _messages(spark: SparkSession, src: str, files_per_batch: int | None = None) -> DataFrame:
    options = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else None
    return stream_source(spark, fmt="text", path=f"{src}/*", options=options)


def _unified_messages(events: DataFrame) -> DataFrame:
    """Normalised rows as the forwarded message stream (K2)."""
    norm = normalize(raw_flows(events), event_time="event_time")
    return forward_payload(norm)


def _raw_messages(events: DataFrame) -> DataFrame:
    return publish_payload(raw_flows(events, with_event_time=False))


def _normalizer(spark: SparkSession, src: str, table: str, ckpt: str):
    """J1's table query; event time from the producer stamp."""
    return jobs.start_normalizer(_messages(spark, src), table, ckpt, trigger=AVAILABLE_NOW,
                                 event_time=F.timestamp_millis(F.col("produced_at_ts")))


def q_stream_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 end to end: K7 payloads -> normaliser -> partitioned table (K1)."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-normalize")
    src, table, ckpt = (f"{work}/{x}" for x in ("src", "table", "ckpt"))
    run_steps(events, in_order_steps(events), _raw_messages, lambda: _normalizer(spark, src, table, ckpt), src)
    return rounded(spark.read.schema(NORMALIZED_SCHEMA).parquet(table).select(*NORMALIZED_COLUMNS))


def _forwarded(sink_rows: DataFrame, schema) -> DataFrame:
    """Messages as (key, fields)."""
    return rounded(decode_json(sink_rows, schema, keep=("key",)))


def q_stream_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1's forwarded messages (K2): the rows that each step adds to the table."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-forward")
    src, table, ckpt, fwd = (f"{work}/{x}" for x in ("src", "table", "ckpt", "forward"))

    def start():
        _normalizer(spark, src, table, f"{ckpt}/table").awaitTermination()
        return jobs.start_forward(spark, table, f"{ckpt}/forward", {"fmt": "json", "path": fwd}, trigger=AVAILABLE_NOW)

    run_steps(events, in_order_steps(events), _raw_messages, start, src)
    return _forwarded(spark.read.schema("key string, value string").json(fwd), NORMALIZED_SCHEMA)


def q_stream_alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2's alert messages (K4) of closed windows, following the window table."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-alert-messages")
    src, table, sink, ckpt = (f"{work}/{x}" for x in ("src", "table", "alerts", "ckpt"))

    def start():
        return jobs.start_aggregator(
            _messages(spark, src), table, ckpt, alert_sink={"fmt": "json", "path": sink}, trigger=AVAILABLE_NOW,
            state_partitions=_state_partitions(spark), width=ALERT_WIDTH, events_threshold=ALERT_EVENTS_THRESHOLD)[-1]

    run_steps(events, in_order_steps(events), _unified_messages, start, src)
    return _forwarded(spark.read.schema("key string, value string").json(sink), WINDOW_SCHEMA).drop("processed_at")


def q_stream_alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 as a stream (K8): alert messages -> text files."""
    work = new_work_dir(spark, "stream-alert-text")
    forward_payload(alerts(day_windows(spark, sf_dir))).select("value").write.text(f"{work}/src/a")
    jobs.start_alert_text(_messages(spark, f"{work}/src"), f"{work}/ckpt", fmt="json", path=f"{work}/out",
                          trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.schema("alert_text string").json(f"{work}/out")


def q_catalog_follows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + C1-C3: tables and views are registered once, after the first
    step; rows of the second are read through the view all the same."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-catalog")
    src, table, ckpt = (f"{work}/{x}" for x in ("src", "table", "ckpt"))
    window_metrics(normalize(raw_flows(events.limit(0)), event_time="event_time")).write.parquet(f"{work}/windows")
    db = "flowlens_stream_" + work.rstrip("/").rsplit("-", 1)[-1]
    for i, step in enumerate(in_order_steps(events)):
        _raw_messages(events.filter(step)).select("value").write.text(f"{src}/step{i}")
        _normalizer(spark, src, table, ckpt).awaitTermination()
        if i == 0:
            register_tables(spark, table, f"{work}/windows", database=db, location=f"{work}/catalog")
            register_views(spark, database=db, persistent=True)
    refresh_tables(spark, db)
    return rounded(spark.sql(f"SELECT * FROM {db}.hourly_traffic"))


def compacted_rounds(spark: SparkSession, events: DataFrame, work: str, database: str, batches: int, event_time=None):
    """Half of the events in ``batches / 2`` micro-batches, a compaction and a
    new view, then the other half and a second compaction and view; a follower
    forwards the table's rows all the while. Yields after each round."""
    src, table, root, ckpt = (f"{work}/{x}" for x in ("src", "table", "compacted", "ckpt"))
    event_time = F.timestamp_millis(F.col("produced_at_ts")) if event_time is None else event_time
    follower = None
    for i, step in enumerate(in_order_steps(events)):
        _raw_messages(events.filter(step)).select("value").repartition(batches // 2, F.xxhash64("value")).write.text(f"{src}/step{i}")
        jobs.start_normalizer(_messages(spark, src, files_per_batch=1), table, f"{ckpt}/table", event_time,
                              trigger=AVAILABLE_NOW).awaitTermination()
        if follower is None:
            follower = jobs.start_forward(spark, table, f"{ckpt}/forward", {"fmt": "json", "path": f"{work}/forward"},
                                          trigger={"processingTime": "0 seconds"})
        compact(spark, table, root, settle_seconds=0.05)
        publish_view(spark, table, root, database=database)
        yield
    follower.processAllAvailable()
    follower.stop()


def q_compacted_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 compacted: the view's rows, and the rows that a follower of the table
    saw meanwhile, after 20 micro-batches and two compactions."""
    work = new_work_dir(spark, "compacted")
    db = "flowlens_compacted_" + work.rstrip("/").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{work}/catalog'")
    for _ in compacted_rounds(spark, load_events(spark, sf_dir), work, db, batches=20):
        pass
    seen = spark.read.schema("key string, value string").json(f"{work}/forward")
    parts = [spark.table(f"{db}.normalized_logs").withColumn("read_from", F.lit("view")),
             decode_json(seen, NORMALIZED_SCHEMA).withColumn("read_from", F.lit("follower"))]
    return rounded(parts[0].unionByName(parts[1]).select("read_from", *NORMALIZED_COLUMNS))


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps, each a restart, the third behind the watermark; every
    hundredth row has no event time. Rows of both tables, the totals that the
    restarts kept, and the windows of the rows on time."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "late-rows")
    src, gate, table, ckpt = (f"{work}/{x}" for x in ("src", "gate", "windows", "ckpt"))

    def to_messages(own: DataFrame) -> DataFrame:
        flows = normalize(raw_flows(own, keep=["event_id"]), event_time="event_time")
        timed = F.when(F.col("produced_at_ts") % 100 != 0, F.col("event_timestamp"))
        return forward_payload(flows.withColumn("event_timestamp", timed))

    def start():
        start_gate(_messages(spark, src), gate, f"{ckpt}/gate", trigger=AVAILABLE_NOW).awaitTermination()
        return jobs.start_window_table(kept_rows(spark, gate), table, f"{ckpt}/windows", trigger=AVAILABLE_NOW,
                                       state_partitions=_state_partitions(spark))

    run_steps(events, late_steps(events), to_messages, start, src)
    rows = spark.read.schema(with_fields(UNIFIED_SCHEMA, ("late_reason", "string"))).parquet(f"{gate}/rows")
    shown = ["src_ip", "dst_port", "event_timestamp"]
    dealt = rows.select(F.coalesce("late_reason", F.lit("ON_TIME")).alias("kind"), *shown, F.lit(1).cast("bigint").alias("n"))
    totals = gate_totals(spark, gate)
    counted = spark.range(1).select(F.explode(F.create_map(*[x for k, v in (
        ("TOTAL_ON_TIME", totals.kept), ("TOTAL_BEHIND_WATERMARK", totals.late), ("TOTAL_NO_EVENT_TIME", totals.without_time),
    ) for x in (F.lit(k), F.lit(v).cast("bigint"))])).alias("kind", "n"))
    closed = spark.read.schema(WINDOW_SCHEMA).parquet(table).select(
        F.lit("WINDOW").alias("kind"), "src_ip", F.col("unique_dst_ports").alias("dst_port"), F.col("window_start").alias("event_timestamp"),
        F.col("event_count").alias("n"))
    return dealt.unionByName(counted, allowMissingColumns=True).unionByName(closed)


def q_incremental_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + K6 from partial aggregates: two passes, each over what is new; all
    five reports as the second pass published them."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "incremental")
    src, table, windows, state, out, ckpt = (f"{work}/{x}" for x in ("src", "table", "windows", "state", "reports", "ckpt"))
    for i, step in enumerate(in_order_steps(events)):
        own = events.filter(step)
        _raw_messages(own).select("value").write.text(f"{src}/step{i}")
        _normalizer(spark, src, table, f"{ckpt}/table").awaitTermination()
        closed = window_metrics(normalize(raw_flows(own), event_time="event_time"))
        closed.write.mode("append").partitionBy(*WINDOW_PARTITIONS).parquet(windows)
        update_reports(spark, table, windows, state, f"{ckpt}/reports", out)
    found = [read_report(spark, out, name).selectExpr(*layout_columns(name)) for name in REPORTS]
    return rounded(reduce(DataFrame.unionByName, found))


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth message is broken: the side table of messages that do not parse."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-quarantine")
    good = _raw_messages(events.where("event_id % 10 <> 0")).select("value")
    bad = events.where("event_id % 10 = 0").select(F.concat(F.lit('{"src_ip": '), F.col("event_id").cast("string")).alias("value"))
    good.unionByName(bad).write.text(f"{work}/src/a")
    jobs.start_quarantine(_messages(spark, f"{work}/src"), f"{work}/bad", f"{work}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(f"{work}/bad").select("value")


def _legacy_messages(events: DataFrame) -> DataFrame:
    raw = raw_flows(events)
    body = raw.select(
        F.col("dst_port").alias("destination_port"),
        "flow_duration", "total_fwd_packets",
        F.col("total_bwd_packets").alias("total_backward_packets"),
        "flow_bytes_s", "flow_packets_s", "syn_flag_count", "label",
        F.date_format("event_time", "yyyy-MM-dd").alias("partition_date"),
        "produced_at_ts",
    )
    return body.select(F.to_json(F.struct(*body.columns)).alias("value"))


LEGACY_OUT = ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets",
              "flow_bytes_s", "flow_packets_s", "syn_flag_count", "label", "partition_date",
              "produced_at_ts"]


def q_stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 end to end: legacy messages -> date-partitioned Parquet sink (K5)."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-archive")
    src, table, ckpt = (f"{work}/{x}" for x in ("src", "table", "ckpt"))

    def start():
        return jobs.start_archive(_messages(spark, src), table, ckpt, trigger=AVAILABLE_NOW)

    run_steps(events, in_order_steps(events), _legacy_messages, start, src)
    schema = with_fields(LEGACY_SCHEMA, ("processed_at", "timestamp"))
    return spark.read.schema(schema).parquet(table).select(*LEGACY_OUT)


def _window_table(spark, sf_dir, steps_fn, name, **window_args) -> DataFrame:
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, name)
    src, table, ckpt = (f"{work}/{x}" for x in ("src", "table", "ckpt"))

    def start():
        return jobs.start_window_table(_messages(spark, src), table, ckpt, trigger=AVAILABLE_NOW,
                                       state_partitions=_state_partitions(spark), **window_args)

    run_steps(events, steps_fn(events), _unified_messages, start, src)
    out = spark.read.schema(WINDOW_SCHEMA).parquet(table).drop("processed_at")
    return rounded(out)


def q_stream_windows_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 table: 5-minute windows in append mode; windows still open at the
    end (end > last event time - 2 minutes) are not written."""
    return _window_table(spark, sf_dir, in_order_steps, "stream-windows")


def q_stream_windows_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 table with late data: the third step is behind the watermark."""
    return _window_table(spark, sf_dir, late_steps, "stream-late")


def q_stream_alerts_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 alerts in update mode: newest version of each window, then alerts.
    Matches the batch alerts."""
    events = load_events(spark, sf_dir)
    work = new_work_dir(spark, "stream-alerts")
    src, updates, sink, ckpt = (f"{work}/{x}" for x in ("src", "updates", "alerts", "ckpt"))

    def start():
        return jobs.start_alert_stream(
            _messages(spark, src), updates, ckpt, alert_sink={"fmt": "json", "path": sink},
            trigger=AVAILABLE_NOW, width=ALERT_WIDTH, events_threshold=ALERT_EVENTS_THRESHOLD,
            state_partitions=_state_partitions(spark),
        )

    run_steps(events, in_order_steps(events), _unified_messages, start, src)
    hist = spark.read.schema(with_fields(WINDOW_SCHEMA, ("batch_id", "bigint"))).parquet(updates)
    latest = latest_per_window(hist.drop("processed_at"))
    return rounded(alerts(latest).select(*[f.name for f in WINDOW_SCHEMA.fields if f.name != "processed_at"]))


def q_alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 over the alert messages (K4) of the batch window alerts."""
    msgs = forward_payload(alerts(day_windows(spark, sf_dir)))
    return alert_text_from_json(msgs)


QUERIES = {
    "stream_normalize": q_stream_normalize,
    "stream_forward": q_stream_forward,
    "stream_alert_messages": q_stream_alert_messages,
    "stream_alert_text": q_stream_alert_text,
    "stream_quarantine": q_stream_quarantine,
    "catalog_follows_stream": q_catalog_follows_stream,
    "stream_late_rows": q_stream_late_rows,
    "compacted_view": q_compacted_view,
    "incremental_reports": q_incremental_reports,
    "stream_archive": q_stream_archive,
    "stream_windows_append": q_stream_windows_append,
    "stream_windows_late": q_stream_windows_late,
    "stream_alerts_latest": q_stream_alerts_latest,
    "alert_text": q_alert_text,
}
