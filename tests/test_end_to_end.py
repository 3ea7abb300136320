"""The jobs chained as in production, on files instead of Kafka:
dataset files -> ingest (J5) -> normaliser (J1) -> aggregator (J2) ->
reports (J3) -> catalog tables and views (C1-C3)."""

from pyspark.sql import functions as F

from flowlens.operators.windows import latest_per_window
from flowlens.plans import source_queries as srcq
from flowlens.plans.jobs import run_ingest, run_reports
from flowlens.sinks.reports import read_report
from flowlens.schemas import WINDOW_SCHEMA, with_fields
from flowlens.sources.events_adapter import load_events
from flowlens.sources.streams import stream_source
from flowlens.sources.tables import register_tables, register_views
from flowlens.streaming import jobs
from tests.conftest import SF_SMALL

NOW = {"availableNow": True}


def test_pipeline(spark, workdir):
    n_events = load_events(spark, SF_SMALL).count()
    # dataset files, as the three datasets lay them out
    raw, first_half = srcq._raw(spark, SF_SMALL)
    srcq._write_cic(raw.filter(F.col("dataset_source") != "unsw"), first_half, workdir)
    srcq._write_unsw(raw.filter(F.col("dataset_source") == "unsw"), first_half, workdir)

    # Publish raw messages (here: JSON files partitioned by topic)
    published = f"{workdir}/published"
    run_ingest(spark, workdir, fmt="json", path=published)
    msgs = spark.read.json(published)
    assert msgs.count() == n_events
    assert {r.topic for r in msgs.select("topic").distinct().collect()} == {
        "raw-cicids", "raw-cicdos", "raw-unsw"}
    msgs.select("value").write.text(f"{workdir}/raw-topic/part0")

    # Normalise with the processing clock, forward to the next topic
    norm_path, fwd = f"{workdir}/normalized-logs", f"{workdir}/logs-normalized"
    for q in jobs.start_normalizer_and_forward(
            stream_source(spark, fmt="text", path=f"{workdir}/raw-topic/*"), norm_path,
            f"{workdir}/ck/normalizer", {"fmt": "json", "path": fwd}, trigger=NOW):
        q.awaitTermination()
    assert spark.read.parquet(norm_path).count() == n_events
    spark.read.json(fwd).select("value").write.text(f"{workdir}/normalized-topic/part0")

    # Window table (append) and alerts (update) from the forwarded topic
    win_path, upd_path, alert_path = (f"{workdir}/{x}" for x in ("aggregations-5min", "updates",
                                                                  "logs-alerts"))
    table_q, alert_q = jobs.start_aggregator(
        stream_source(spark, fmt="text", path=f"{workdir}/normalized-topic/*"),
        win_path, f"{workdir}/ck/aggregator", alert_sink={"fmt": "json", "path": alert_path},
        updates_path=upd_path, trigger=NOW, state_partitions=4, events_threshold=3)
    table_q.awaitTermination()
    alert_q.awaitTermination()
    hist = spark.read.schema(with_fields(WINDOW_SCHEMA, ("batch_id", "bigint"))).parquet(upd_path)
    latest = latest_per_window(hist.drop("processed_at"))
    assert latest.agg(F.sum("event_count")).first()[0] == n_events
    # all rows carry one processing time, so every window is still open
    assert spark.read.schema(WINDOW_SCHEMA).parquet(win_path).count() == 0

    # J3 over the tables, then the catalog and the views
    reports = f"{workdir}/reports"
    assert run_reports(spark, norm_path, upd_path, reports)
    dist = read_report(spark, reports, "attack_distribution")
    assert dist.agg(F.sum("event_count")).first()[0] == n_events
    db = "e2e_" + workdir.rstrip("/").rsplit("-", 1)[-1]
    register_tables(spark, norm_path, win_path, reports_path=reports, database=db,
                    location=f"{workdir}/catalog")
    register_views(spark, database=db, persistent=True)
    assert spark.sql(f"SELECT count(*) AS n FROM {db}.normalized_logs").first().n == n_events
    assert spark.sql(f"SELECT sum(event_count) AS n FROM {db}.recent_attacks").first().n > 0
    assert spark.sql(f"SELECT count(*) AS n FROM {db}.report_attack_distribution").first().n > 0
    assert spark.sql(f"SELECT * FROM {db}.top_src_ips LIMIT 10").count() == 10
    assert spark.sql(f"SELECT count(*) AS n FROM {db}.active_alerts").first().n == 0  # all open


def test_window_table_from_the_file_sink_registers(spark, workdir):
    """The append-mode window table (file sink, no batch level) and a table
    written batch by batch (batch level) both register and read back whole."""
    from flowlens.plans import stream_queries as sq
    from flowlens.plans.batch_queries import flows
    from flowlens.schemas import NORMALIZED_PARTITIONS
    from flowlens.sinks.writers import write_batch_partitioned

    events = load_events(spark, SF_SMALL)
    src, win = f"{workdir}/src", f"{workdir}/win"
    sq._unified_messages(events).select("value").write.text(f"{src}/step0")
    jobs.start_window_table(stream_source(spark, fmt="text", path=f"{src}/*"), win,
                            f"{workdir}/ck", trigger=NOW, state_partitions=4,
                            width="1 day", events_threshold=3).awaitTermination()
    norm_path = f"{workdir}/norm"
    write_batch_partitioned(flows(spark, SF_SMALL), norm_path, NORMALIZED_PARTITIONS, 0)
    db = "wt_" + workdir.rstrip("/").rsplit("-", 1)[-1]
    register_tables(spark, norm_path, win, database=db, batch_partition=True, location=f"{workdir}/catalog")
    closed = spark.read.schema(WINDOW_SCHEMA).parquet(win).count()
    assert closed > 0
    assert spark.table(f"{db}.aggregations_5min").count() == closed
    assert spark.table(f"{db}.normalized_logs").count() == events.count()
    register_views(spark, database=db, as_of="2024-01-30", persistent=True)
    assert spark.sql(f"SELECT count(*) AS n FROM {db}.active_alerts").first().n > 0


def test_cli_archive_and_alert_text(spark, workdir):
    """J4 and J6 through the command line on message files."""
    from flowlens import cli
    from flowlens.functions.payload import alert_text_from_json, forward_payload
    from flowlens.operators.windows import alerts, window_metrics
    from flowlens.plans import stream_queries as sq
    from flowlens.plans.batch_queries import flows
    from flowlens.schemas import LEGACY_SCHEMA

    events = load_events(spark, SF_SMALL)
    sq._legacy_messages(events).write.text(f"{workdir}/legacy/a")
    cli.main(["archive", "--table", f"{workdir}/archive", "--checkpoint", f"{workdir}/c1",
              "--source-format", "text", "--source-path", f"{workdir}/legacy/*",
              "--available-now"])
    archived = spark.read.schema(with_fields(LEGACY_SCHEMA, ("processed_at", "timestamp"))) \
        .parquet(f"{workdir}/archive")
    assert archived.count() == events.count()
    assert archived.filter("processed_at IS NULL OR partition_date IS NULL").count() == 0

    win = window_metrics(flows(spark, SF_SMALL), width="1 day", events_threshold=3)
    msgs = forward_payload(alerts(win))
    msgs.select("value").write.text(f"{workdir}/alerts/a")
    cli.main(["alert-text", "--checkpoint", f"{workdir}/c2", "--source-format", "text",
              "--source-path", f"{workdir}/alerts/*", "--output", "json",
              "--output-path", f"{workdir}/texts", "--available-now"])
    got = spark.read.schema("alert_text string").json(f"{workdir}/texts")
    want = alert_text_from_json(msgs)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_ingest_reads_csv_and_zip_together(spark, workdir):
    """J5 over a CIC-IDS-2017 folder holding plain and zipped CSV files."""
    from flowlens.plans import fixtures

    raw, _ = srcq._raw(spark, SF_SMALL)
    cic = raw.filter(F.col("dataset_source") == "cicids")
    plain, zipped = cic.filter(F.col("binary_label") == "0"), cic.filter(F.col("binary_label") == "1")
    A = fixtures.CIC_HEADER_A
    fixtures.write_files(fixtures.cic_layout(plain, A), f"{workdir}/CIC-IDS-2017", "Mon_", A)
    fixtures.write_files(fixtures.cic_layout(zipped, A), f"{workdir}/CIC-IDS-2017", "Tue_", A, zipped=True)
    run_ingest(spark, workdir, fmt="json", path=f"{workdir}/out")
    got = spark.read.json(f"{workdir}/out")
    assert got.count() == cic.count()
    assert {r.topic for r in got.select("topic").distinct().collect()} == {"raw-cicids"}


def test_windows_by_destination_port_stream(spark, workdir):
    """D6 on the stream: windows keyed by destination port match the batch."""
    from flowlens.operators.windows import window_metrics
    from flowlens.plans import stream_queries as sq
    from flowlens.plans.batch_queries import flows

    events = load_events(spark, SF_SMALL)
    sq._unified_messages(events).select("value").write.text(f"{workdir}/src/a")
    keys = ("dst_port", "dataset_source")
    jobs.start_window_table(stream_source(spark, fmt="text", path=f"{workdir}/src/*"),
                            f"{workdir}/win", f"{workdir}/ck", trigger=NOW, state_partitions=4,
                            width="1 hour", keys=keys, events_threshold=5000).awaitTermination()
    got = spark.read.parquet(f"{workdir}/win").select("window_start", *keys, "event_count")
    batch = window_metrics(flows(spark, SF_SMALL), width="1 hour", keys=keys) \
        .select("window_start", *keys, "event_count")
    closed = batch.filter(F.col("window_start") < F.lit("2024-01-30 23:00:00").cast("timestamp"))
    assert got.count() > 0
    assert got.exceptAll(batch).count() == 0
    assert closed.exceptAll(got).count() == 0
