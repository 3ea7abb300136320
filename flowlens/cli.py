"""Command line for the jobs: ``python -m flowlens.cli <job> [options]``.

Settings come from options, whose defaults environment variables may set
(``KAFKA_BOOTSTRAP_SERVERS``, ``INPUT_TOPICS``, ...). Paths (tables, checkpoints) are options; on a cluster
they point into the shared folder.
"""

from __future__ import annotations

import argparse
import os

from flowlens.sources import streams


def _env(name: str, default: str) -> str:
    return os.environ.get(name, default)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Producer settings of the ingest (batching, linger, compression).
INGEST_PRODUCER = {
    "kafka.linger.ms": "50",
    "kafka.batch.size": "65536",
    "kafka.compression.type": "lz4",
}


def _session(app: str, stateful: bool = False):
    """The cluster's session. Shuffle sizing is left to the cluster's
    settings and AQE; a stateful stream uses the RocksDB state store (state
    off the JVM heap, many keys per executor) unless one is configured."""
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        # checkpointed intermediates (the report rollup) are removed once unused
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .getOrCreate()
    )
    if stateful and not spark.conf.get("spark.sql.streaming.stateStore.providerClass", None):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def wait_for_all(queries) -> None:
    """Until all queries have ended. The first that fails stops the others, and
    its error is raised: a job never goes on with a part of it missing."""
    try:
        while running := [q for q in queries if q.isActive]:
            running[0].awaitTermination(1)
            for q in queries:
                if not q.isActive:
                    q.awaitTermination()  # raises its error
        for q in queries:
            q.awaitTermination()
    except Exception:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="flowlens")
    p.add_argument("--kafka-option", action="append", default=[], metavar="KEY=VALUE",
                   help="extra Kafka client setting for sources and sinks (e.g. "
                        "security.protocol=SASL_SSL); repeatable")
    sub = p.add_subparsers(dest="job", required=True)
    brokers = _env("KAFKA_BOOTSTRAP_SERVERS", streams.DEFAULT_BROKERS)

    n = sub.add_parser("normalize", help="J1: raw topics -> normalised table + topic")
    n.add_argument("--table", required=True)
    n.add_argument("--checkpoint", required=True)
    n.add_argument("--topics", default=_env("INPUT_TOPICS", streams.RAW_TOPICS))
    n.add_argument("--output-topic", default=_env("OUTPUT_TOPIC", streams.NORMALIZED_TOPIC))
    n.add_argument("--quarantine", default=None, help="folder of messages that do not parse")

    a = sub.add_parser("aggregate", help="J2: windows table (append) + alerts (update)")
    a.add_argument("--table", required=True)
    a.add_argument("--updates", default=None,
                   help="folder of early alerts' window updates; without it alerts follow the table")
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--topic", default=_env("INPUT_TOPIC", streams.NORMALIZED_TOPIC))
    a.add_argument("--alert-topic", default=_env("ALERT_TOPIC", streams.ALERT_TOPIC))
    a.add_argument("--events-threshold", type=int, default=int(_env("ALERT_THRESHOLD_EVENTS", "500")))
    a.add_argument("--syn-threshold", type=float, default=float(_env("ALERT_THRESHOLD_SYN", "0.8")))
    a.add_argument("--width", default="5 minutes")
    a.add_argument("--keys", default="src_ip,dataset_source",
                   help="grouping columns besides the window, comma separated")

    r = sub.add_parser("report", help="J3: one pass of the five reports")
    r.add_argument("--normalized", required=True)
    r.add_argument("--windows", required=True)
    r.add_argument("--reports", required=True)
    r.add_argument("--state", default=None, help="folder of partial aggregates: read only what is new (needs --checkpoint)")
    r.add_argument("--checkpoint", default=None)
    r.add_argument("--database", default=None, help="point its report tables at the new reports")

    k = sub.add_parser("compact", help="copy a streaming table's files into large ones behind one view")
    k.add_argument("--table", required=True, help="the sink's folder")
    k.add_argument("--segments", required=True, help="folder of the compacted files")
    k.add_argument("--kind", choices=["normalized", "windows"], default="normalized")
    k.add_argument("--database", default=None, help="replace the table's view there")

    c = sub.add_parser("archive", help="J4: legacy topic -> date-partitioned Parquet")
    c.add_argument("--table", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--topic", default=_env("KAFKA_TOPIC", streams.LEGACY_TOPIC))

    i = sub.add_parser("ingest", help="J5: dataset files -> raw topics, once")
    i.add_argument("--data-dir", default=_env("DATA_DIR", "/app/data"))
    i.add_argument("--checkpoint", default=None, help="ledger of published files: publish only those it does not hold")

    t = sub.add_parser("alert-text", help="J6: alert topic -> printed alert text")
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--output", default="print", help="print, console, or a file format")
    t.add_argument("--output-path", default=None)
    t.add_argument("--topic", default=_env("ALERT_TOPIC", streams.ALERT_TOPIC))

    for stateful_cmd in (a, c, t):
        stateful_cmd.add_argument(
            "--state-partitions", type=int, default=None,
            help="shuffle/state partitions of a new stream (fixed by its checkpoint afterwards)")
    for stream_cmd in (n, a, c, t):
        stream_cmd.add_argument("--source-format", default="kafka",
                                help="kafka, or a file format whose lines are messages (text)")
        stream_cmd.add_argument("--source-path", default=None, help="folder of message files")
        stream_cmd.add_argument("--available-now", action="store_true",
                                help="process what is there and stop (backfill)")
        stream_cmd.add_argument("--max-per-trigger", type=int, default=None,
                                help="bound a micro-batch: Kafka offsets (or files) per trigger")
    for fwd_cmd in (n, a):
        fwd_cmd.add_argument("--sink-format", default="kafka",
                             help="kafka, or a file format for the forwarded messages")
        fwd_cmd.add_argument("--sink-path", default=None, help="folder for file-format messages")
    args = p.parse_args(argv)
    kafka = {"kafka.bootstrap.servers": brokers}
    for item in args.kafka_option:
        key, _, value = item.partition("=")
        kafka[key if key.startswith("kafka.") else f"kafka.{key}"] = value

    def source(spark, topics, fail_on_data_loss=False):
        options = {k: v for k, v in kafka.items() if k != "kafka.bootstrap.servers"} \
            if args.source_format == "kafka" else {}
        if args.max_per_trigger:
            key = "maxOffsetsPerTrigger" if args.source_format == "kafka" else "maxFilesPerTrigger"
            options[key] = str(args.max_per_trigger)
        return streams.stream_source(spark, fmt=args.source_format, topics=topics, brokers=brokers,
                                     path=args.source_path, fail_on_data_loss=fail_on_data_loss,
                                     options=options)

    def sink(topic):
        if args.sink_format == "kafka":
            return {"fmt": "kafka", "topic": topic, "options": kafka}
        return {"fmt": args.sink_format, "path": args.sink_path}

    if args.job == "report":
        from flowlens.plans.jobs import run_reports
        from flowlens.streaming.report_state import update_reports

        if bool(args.state) != bool(args.checkpoint):
            p.error("--state and --checkpoint go together")
        spark = _session("flowlens-report")
        if args.state:
            update_reports(spark, args.normalized, args.windows, args.state, args.checkpoint, args.reports, args.database)
        else:
            run_reports(spark, args.normalized, args.windows, args.reports, args.database)
        return
    if args.job == "compact":
        from flowlens import schemas
        from flowlens.sinks.compaction import compact, publish_view

        spark = _session("flowlens-compact")
        name, schema, parts = {"normalized": ("normalized_logs", schemas.NORMALIZED_SCHEMA, schemas.NORMALIZED_PARTITIONS),
                               "windows": ("aggregations_5min", schemas.WINDOW_SCHEMA, schemas.WINDOW_PARTITIONS)}[args.kind]
        compact(spark, args.table, args.segments, schema, parts)
        if args.database:
            publish_view(spark, args.table, args.segments, name, args.database, schema, parts)
        return
    if args.job == "ingest":
        from flowlens.plans.jobs import run_ingest
        from flowlens.streaming.ingest_files import start_ingest

        if args.checkpoint:
            wait_for_all([start_ingest(_session("flowlens-ingest"), args.data_dir, args.checkpoint, fmt="kafka",
                                       options={**kafka, **INGEST_PRODUCER}, trigger={"availableNow": True})])
            return
        run_ingest(_session("flowlens-ingest"), args.data_dir, fmt="kafka",
                   options={**kafka, **INGEST_PRODUCER})
        return

    from flowlens.streaming import jobs

    trigger = {"availableNow": True} if args.available_now else None
    started = []
    if args.job == "normalize":
        spark = _session("flowlens-normalize")
        started.extend(jobs.start_normalizer_and_forward(
            source(spark, args.topics), args.table, args.checkpoint,
            sink(args.output_topic), trigger=trigger))
        if args.quarantine:
            started.append(jobs.start_quarantine(source(spark, args.topics), args.quarantine,
                                                 f"{args.checkpoint.rstrip('/')}/quarantine", trigger=trigger))
    elif args.job == "aggregate":
        spark = _session("flowlens-aggregate", stateful=True)
        started.extend(jobs.start_aggregator(
            source(spark, args.topic), args.table, args.checkpoint,
            alert_sink=sink(args.alert_topic), updates_path=args.updates, trigger=trigger,
            width=args.width, events_threshold=args.events_threshold,
            syn_threshold=args.syn_threshold, state_partitions=args.state_partitions,
            keys=tuple(k.strip() for k in args.keys.split(",") if k.strip())))
    elif args.job == "archive":
        spark = _session("flowlens-archive")
        started.append(jobs.start_archive(source(spark, args.topic, None), args.table,
                                          args.checkpoint, trigger=trigger,
                                          state_partitions=args.state_partitions))
    elif args.job == "alert-text":
        spark = _session("flowlens-alert-text")
        started.append(jobs.start_alert_text(source(spark, args.topic), args.checkpoint,
                                             fmt=args.output, path=args.output_path,
                                             trigger=trigger,
                                             state_partitions=args.state_partitions))
    wait_for_all(started)


if __name__ == "__main__":
    main()
