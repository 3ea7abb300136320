"""Streaming and table behaviour: restarts, late data, update vs append,
idempotent batch writes, missing paths, catalog views, the report job."""

import os

from pyspark.sql import functions as F

from flowlens.operators import views
from flowlens.operators.windows import latest_per_window
from flowlens.plans import stream_queries as sq
from flowlens.plans.batch_queries import flows
from flowlens.plans.jobs import run_reports
from flowlens.sinks.reports import read_report
from flowlens.schemas import NORMALIZED_PARTITIONS, WINDOW_PARTITIONS, WINDOW_SCHEMA, with_fields
from flowlens.sinks.writers import write_batch_partitioned, write_partitioned
from flowlens.sources.events_adapter import load_events
from flowlens.sources.tables import read_parquet_or_none, register_tables, register_views
from flowlens.streaming import jobs
from tests.conftest import SF_SMALL


def _window_run(spark, workdir, steps):
    events = load_events(spark, SF_SMALL)
    src, table, ckpt = (f"{workdir}/{x}" for x in ("src", "table", "ckpt"))
    queries = []

    def start():
        q = jobs.start_window_table(sq._messages(spark, src), table, ckpt, trigger=sq.AVAILABLE_NOW)
        queries.append(q)
        return q

    sq.run_steps(events, steps(events), sq._unified_messages, start, src)
    return table, ckpt, queries, start


def test_restart_without_new_data_adds_nothing(spark, workdir):
    table, _, _, start = _window_run(spark, workdir, sq.in_order_steps)
    before = spark.read.parquet(table).count()
    q = start()
    q.awaitTermination()
    after = spark.read.parquet(table).count()
    assert before == after > 0


def test_late_rows_are_counted_and_dropped(spark, workdir):
    counter = jobs.count_late_input(spark)
    try:
        _, _, queries, _ = _window_run(spark, workdir, sq.late_steps)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        want = sum(op.numRowsDroppedByWatermark for q in queries for p in q.recentProgress for op in p.stateOperators)
        assert counter.dropped[str(queries[-1].id)] == want > 0
    finally:
        spark.streams.removeListener(counter)


def test_update_mode_newest_equals_append(spark, workdir):
    events = load_events(spark, SF_SMALL)
    src, upd, ckpt = (f"{workdir}/{x}" for x in ("src", "updates", "ckpt"))

    def start():
        return jobs.start_alert_stream(sq._messages(spark, src), upd, ckpt, trigger=sq.AVAILABLE_NOW,
                                       width="1 day", events_threshold=3)

    sq.run_steps(events, sq.in_order_steps(events), sq._unified_messages, start, src)
    hist = spark.read.schema(with_fields(WINDOW_SCHEMA, ("batch_id", "bigint"))).parquet(upd)
    assert hist.select("batch_id").distinct().count() >= 2
    latest = latest_per_window(hist.drop("processed_at"))
    from flowlens.operators.windows import window_metrics

    batch = window_metrics(flows(spark, SF_SMALL), width="1 day", events_threshold=3).drop("processed_at")
    keys = ["window_start", "src_ip", "dataset_source"]
    cols = ["event_count", "unique_labels", "unique_dst_ports", "total_syn_flags"]
    a = latest.select(*keys, *cols)
    b = batch.select(*keys, *cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_write_is_idempotent(spark, workdir):
    df = flows(spark, SF_SMALL)
    path = f"{workdir}/norm"
    write_batch_partitioned(df, path, NORMALIZED_PARTITIONS, batch_id=7)
    write_batch_partitioned(df, path, NORMALIZED_PARTITIONS, batch_id=7)
    write_batch_partitioned(df.limit(5), path, NORMALIZED_PARTITIONS, batch_id=8)
    back = spark.read.parquet(path)
    assert back.filter("batch_id = 7").count() == df.count()
    assert back.filter("batch_id = 8").count() == 5


def test_missing_path_is_none(spark, workdir):
    assert read_parquet_or_none(spark, f"{workdir}/nothing-here") is None


def test_catalog_tables_and_views(spark, workdir):
    norm = flows(spark, SF_SMALL)
    from flowlens.operators.windows import window_metrics

    win = window_metrics(norm, width="1 day", events_threshold=3)
    npath, wpath = f"{workdir}/normalized-logs", f"{workdir}/aggregations-5min"
    write_partitioned(norm, npath, NORMALIZED_PARTITIONS)
    write_partitioned(win, wpath, WINDOW_PARTITIONS)
    db = "flowlens_t_" + os.path.basename(workdir).replace("-", "_")
    register_tables(spark, npath, wpath, database=db, location=f"{workdir}/cat")
    register_views(spark, database=db, as_of="2024-01-30")
    via_sql = spark.sql("SELECT * FROM recent_attacks")
    direct = views.recent_attacks(norm, as_of="2024-01-30")
    assert via_sql.exceptAll(direct).count() == 0 and direct.exceptAll(via_sql).count() == 0
    assert spark.sql("SELECT count(*) AS n FROM active_alerts").first().n == \
        views.active_alerts(win, as_of="2024-01-30").count()
    register_views(spark, database=db, as_of="2024-01-30", persistent=True)
    for name, direct in (
        ("recent_attacks", views.recent_attacks(norm, as_of="2024-01-30")),
        ("top_src_ips", views.top_src_ips(norm)),
        ("hourly_traffic", views.hourly_traffic(norm)),
        ("active_alerts", views.active_alerts(win, as_of="2024-01-30")),
    ):
        stored = spark.table(f"{db}.{name}")
        assert stored.columns == direct.columns, name
        assert stored.exceptAll(direct).count() == 0 and direct.exceptAll(stored).count() == 0, name
    # the benign filter reads only the Benign partition directories
    plan = spark.table(f"{db}.normalized_logs").filter("attack_category = 'Benign'") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(attack_category" in plan


def test_report_job_writes_five_reports(spark, workdir):
    norm = flows(spark, SF_SMALL)
    from flowlens.operators.windows import window_metrics

    npath, wpath, rpath = f"{workdir}/n", f"{workdir}/w", f"{workdir}/reports"
    assert run_reports(spark, npath, wpath, rpath) is False
    write_partitioned(norm, npath, NORMALIZED_PARTITIONS)
    write_partitioned(window_metrics(norm), wpath, WINDOW_PARTITIONS)
    assert run_reports(spark, npath, wpath, rpath) is True
    for name in ("attack_distribution", "hourly_timeseries", "behavioral_profiles",
                 "benign_baseline", "aggregation_summary"):
        assert read_report(spark, rpath, name).count() > 0, name


def test_rollup_reports_equal_direct(spark):
    from flowlens.operators import reports

    norm = flows(spark, SF_SMALL)
    rollup = reports.traffic_rollup(norm)
    for direct, derived in (
        (reports.attack_distribution(norm), reports.attack_distribution_from_rollup(rollup)),
        (reports.hourly_timeseries(norm), reports.hourly_timeseries_from_rollup(rollup)),
    ):
        assert direct.collect() == derived.collect()


def test_alert_text_stream_matches_batch(spark, workdir):
    """Alert messages (K4 JSON) -> streaming text projection."""
    from flowlens.functions.payload import alert_text_from_json, forward_payload
    from flowlens.operators.windows import alerts, window_metrics
    from flowlens.sources.streams import stream_source

    win = window_metrics(flows(spark, SF_SMALL), width="1 day", events_threshold=3)
    msgs = forward_payload(alerts(win))
    src, out, ckpt = (f"{workdir}/{x}" for x in ("src", "out", "ckpt"))
    msgs.select("value").write.text(f"{src}/step0")
    q = jobs.start_alert_text(stream_source(spark, fmt="text", path=f"{src}/*"), ckpt,
                              fmt="json", path=out, trigger={"availableNow": True})
    q.awaitTermination()
    got = spark.read.schema("alert_text string").json(out)
    want = alert_text_from_json(msgs)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_cli_report(spark, workdir):
    from flowlens import cli
    from flowlens.operators.windows import window_metrics

    norm = flows(spark, SF_SMALL)
    npath, wpath, rpath = f"{workdir}/n", f"{workdir}/w", f"{workdir}/r"
    write_partitioned(norm, npath, NORMALIZED_PARTITIONS)
    write_partitioned(window_metrics(norm), wpath, WINDOW_PARTITIONS)
    cli.main(["report", "--normalized", npath, "--windows", wpath, "--reports", rpath])
    assert spark.read.parquet(f"{rpath}/attack_distribution").count() > 0


def test_hot_source_address(spark):
    """One address holds a third of the rows: window metrics still match a
    brute-force count, no row is copied, and the port is part of the first
    shuffle key, so the hot address is spread over its ports."""
    from flowlens.operators.windows import window_metrics

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("10.9.9.9"))
        .otherwise(F.concat(F.lit("10.0.0."), (F.col("id") % 50).cast("string"))).alias("src_ip"),
        F.lit("cicids").alias("dataset_source"),
        (F.col("id") % 997).alias("dst_port"),
        F.concat(F.lit("L"), (F.col("id") % 7).cast("string")).alias("label"),
        (F.col("id") % 13).cast("double").alias("flow_duration"),
        (F.col("id") % 17).cast("double").alias("flow_bytes_s"),
        (F.col("id") % 2).alias("syn_flag_count"),
        (F.col("id") % 5).alias("total_fwd_packets"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3600).alias("event_timestamp"),
    )
    w = window_metrics(df, width="1 hour")
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "__port" in plan
    got = {r.src_ip: (r.event_count, r.unique_dst_ports, r.unique_labels, r.total_syn_flags)
           for r in w.collect()}
    pdf = df.toPandas()
    want = pdf.groupby("src_ip").agg(
        n=("dst_port", "size"), ports=("dst_port", "nunique"), labels=("label", "nunique"),
        syn=("syn_flag_count", "sum"))
    assert len(got) == len(want)
    for ip, row in want.iterrows():
        assert got[ip] == (row.n, row.ports, row.labels, row.syn), ip
    assert got["10.9.9.9"][0] == n // 3


def test_processing_time_stamp(spark):
    """Without an event-time column rows are stamped with the clock."""
    import datetime as dt

    from flowlens.operators.normalize import normalize
    from flowlens.sources.events_adapter import raw_flows

    raw = raw_flows(load_events(spark, SF_SMALL), with_event_time=False)
    row = normalize(raw).select("event_timestamp", "partition_date").first()
    assert row.event_timestamp is not None
    assert row.partition_date == row.event_timestamp.strftime("%Y-%m-%d")
    assert abs((dt.datetime.now() - row.event_timestamp).total_seconds()) < 3600 * 24


def test_cli_streams_from_files(spark, workdir):
    """J1 then J2 through the command line, on message files (backfill mode)."""
    from flowlens import cli
    from flowlens.functions.payload import publish_payload
    from flowlens.sources.events_adapter import raw_flows

    events = load_events(spark, SF_SMALL)
    raw_msgs = f"{workdir}/raw"
    publish_payload(raw_flows(events, with_event_time=False)).select("value").write.text(f"{raw_msgs}/a")
    norm_tbl, fwd = f"{workdir}/norm", f"{workdir}/fwd"
    cli.main(["normalize", "--table", norm_tbl, "--checkpoint", f"{workdir}/c1",
              "--source-format", "text", "--source-path", f"{raw_msgs}/*",
              "--sink-format", "json", "--sink-path", fwd, "--available-now",
              "--state-partitions", "4"])
    assert spark.read.parquet(norm_tbl).count() == events.count()
    fwd_msgs = spark.read.json(fwd)
    assert fwd_msgs.count() == events.count()
    fwd_msgs.select("value").write.text(f"{workdir}/fwdtext/a")
    cli.main(["aggregate", "--table", f"{workdir}/win", "--updates", f"{workdir}/upd",
              "--checkpoint", f"{workdir}/c2", "--source-format", "text",
              "--source-path", f"{workdir}/fwdtext/*", "--sink-format", "json",
              "--sink-path", f"{workdir}/alerts", "--available-now", "--state-partitions", "4",
              "--events-threshold", "0"])
    # every row carries the same processing-time stamp, so all windows are
    # still open: the append table is empty, the update history is not
    assert spark.read.parquet(f"{workdir}/upd").count() > 0
    assert spark.read.json(f"{workdir}/alerts").count() > 0


def test_approximate_distinct_option(spark):
    """distinct="approx" (HyperLogLog) stays close to the exact counts."""
    from flowlens.operators.windows import window_metrics

    norm = flows(spark, SF_SMALL)
    exact = window_metrics(norm, width="1 day").select(
        "window_start", "src_ip", "dataset_source", "unique_dst_ports", "unique_labels")
    approx = window_metrics(norm, width="1 day", distinct="approx").select(
        "window_start", "src_ip", "dataset_source",
        F.col("unique_dst_ports").alias("a_ports"), F.col("unique_labels").alias("a_labels"))
    joined = exact.join(approx, exact["window_start"].eqNullSafe(approx["window_start"])
                        & exact["src_ip"].eqNullSafe(approx["src_ip"])
                        & exact["dataset_source"].eqNullSafe(approx["dataset_source"]))
    rows = joined.collect()
    assert len(rows) == exact.count()
    for r in rows:
        assert abs(r.a_ports - r.unique_dst_ports) <= max(1, 0.1 * r.unique_dst_ports)
        assert abs(r.a_labels - r.unique_labels) <= max(1, 0.1 * r.unique_labels)


def test_alert_text_printed(spark, workdir, capsys):
    """J6 print mode: the stream runs the foreach printer; each alert's text
    is printed as it is (workers print to their own stdout)."""
    from pyspark.sql import Row

    from flowlens.functions.payload import forward_payload
    from flowlens.operators.windows import alerts, window_metrics
    from flowlens.sources.streams import stream_source

    win = window_metrics(flows(spark, SF_SMALL), width="1 day", events_threshold=3)
    msgs = forward_payload(alerts(win).limit(3))
    src = f"{workdir}/src"
    msgs.select("value").write.text(f"{src}/step0")
    q = jobs.start_alert_text(stream_source(spark, fmt="text", path=f"{src}/*"), f"{workdir}/ck",
                              fmt="print", trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    assert q.recentProgress[-1].numInputRows in (0, 3) and sum(
        p.numInputRows for p in q.recentProgress) == 3
    jobs._print_alert(Row(alert_text="line one\nline two\n"))
    assert capsys.readouterr().out == "line one\nline two\n\n"


def test_no_benign_rows_no_baseline(spark):
    """without benign flows the baseline report has no row."""
    from flowlens.operators import reports

    attacks_only = flows(spark, SF_SMALL).filter("attack_category <> 'Benign'")
    assert reports.benign_baseline(attacks_only).count() == 0
    assert reports.benign_baseline(flows(spark, SF_SMALL)).count() == 1


def test_alert_then_not_alert(spark, workdir):
    """Update mode: a window alerts in one micro-batch and stops being an
    alert in the next. The alert messages keep the early alert; the newest
    version of the window says it is no longer one."""
    import json

    from flowlens.sources.streams import stream_source

    def rows(n, syn, fwd, second):
        return [json.dumps({
            "src_ip": "10.5.5.5", "dst_port": 80 + i, "label": "Syn", "dataset_source": "cicdos",
            "flow_duration": 1.0, "flow_bytes_s": 2.0, "syn_flag_count": syn,
            "total_fwd_packets": fwd, "event_timestamp": f"2024-01-01T10:00:{second + i:02d}.000Z",
        }) for i in range(n)]

    src, upd, sink = f"{workdir}/src", f"{workdir}/upd", f"{workdir}/alerts"
    steps = [rows(2, 9, 10, 0), rows(2, 0, 10, 10)]
    for i, lines in enumerate(steps):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.text(f"{src}/step{i}")
        q = jobs.start_alert_stream(stream_source(spark, fmt="text", path=f"{src}/*"), upd,
                                    f"{workdir}/ck", alert_sink={"fmt": "json", "path": sink},
                                    trigger={"availableNow": True}, width="1 day",
                                    state_partitions=2)
        q.awaitTermination()
    sent = spark.read.json(sink).select(F.get_json_object("value", "$.syn_flag_ratio").alias("r"))
    assert [float(r.r) for r in sent.collect()] == [0.9]
    hist = spark.read.schema(with_fields(WINDOW_SCHEMA, ("batch_id", "bigint"))).parquet(upd)
    latest = latest_per_window(hist.drop("processed_at")).first()
    assert latest.event_count == 4 and latest.syn_flag_ratio == 0.45 and latest.is_alert is False


def test_alert_history_prunes_by_day(spark, workdir):
    """The update history is partitioned by window day: a date filter is a
    partition filter."""
    from flowlens.sources.streams import stream_source

    events = load_events(spark, SF_SMALL)
    src, upd = f"{workdir}/src", f"{workdir}/upd"
    sq._unified_messages(events).select("value").write.text(f"{src}/step0")
    q = jobs.start_alert_stream(stream_source(spark, fmt="text", path=f"{src}/*"), upd,
                                f"{workdir}/ck", trigger={"availableNow": True}, width="1 day",
                                events_threshold=3, state_partitions=4)
    q.awaitTermination()
    hist = spark.read.schema(with_fields(WINDOW_SCHEMA, ("batch_id", "bigint"))).parquet(upd)
    recent = hist.filter("window_start_date >= '2024-01-29'")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_start_date" in plan
    assert recent.count() > 0
    assert recent.select("window_start_date").distinct().count() == 2


def test_normalizer_layout_and_replay(spark, workdir):
    """Category and date folders only, every row once, also after a restart."""
    import os

    from flowlens.sources.streams import stream_source

    events = load_events(spark, SF_SMALL)
    src, table = f"{workdir}/src", f"{workdir}/table"
    sq._raw_messages(events).select("value").write.text(f"{src}/a")
    for _ in range(2):
        jobs.start_normalizer(stream_source(spark, fmt="text", path=f"{src}/*"), table,
                              f"{workdir}/ck", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(table).count() == events.count()
    local = table[5:] if table.startswith("file:") else table
    cat_dir = sorted(d for d in os.listdir(local) if d.startswith("attack_category="))[0]
    inner = os.listdir(os.path.join(local, cat_dir))
    assert inner and all(d.startswith("partition_date=") for d in inner)
    assert not any("batch_id=" in d for d in os.listdir(os.path.join(local, cat_dir, inner[0])))


def test_added_partitions_are_seen(spark, workdir):
    """Batch-written tables: a later batch's folders are added one by one."""
    from flowlens.sources.tables import add_partitions

    norm = flows(spark, SF_SMALL)
    parts = [*NORMALIZED_PARTITIONS, "batch_id"]
    path, win = f"{workdir}/n", f"{workdir}/w"
    write_batch_partitioned(norm.limit(50), path, NORMALIZED_PARTITIONS, 0)
    write_partitioned(spark.createDataFrame([], WINDOW_SCHEMA), win, WINDOW_PARTITIONS)
    db = "flowlens_add_" + os.path.basename(workdir).replace("-", "_")
    register_tables(spark, path, win, database=db, batch_partition=True, location=f"{workdir}/cat")
    assert spark.table(f"{db}.normalized_logs").count() == 50
    write_batch_partitioned(norm.limit(50), path, NORMALIZED_PARTITIONS, 1)
    add_partitions(spark, f"{db}.normalized_logs", norm.limit(50).withColumn("batch_id", F.lit(1)), parts)
    assert spark.table(f"{db}.normalized_logs").count() == 100
    add_partitions(spark, f"{db}.normalized_logs", norm.limit(0).withColumn("batch_id", F.lit(1)), parts)
