"""Versions, compaction of sink tables, incremental and atomic reports."""

import pytest
from pyspark.sql import functions as F

from flowlens.plans import stream_queries as sq
from flowlens.plans.batch_queries import rounded
from flowlens.plans.jobs import run_reports
from flowlens.plans.layout import REPORTS
from flowlens.schemas import NORMALIZED_PARTITIONS, NORMALIZED_SCHEMA
from flowlens.sinks.compaction import compact, publish_view, read_live
from flowlens.sinks.reports import publish_reports, read_report, report_path
from flowlens.sinks.versions import Version, Versions, small_tail
from flowlens.sinks.writers import write_batch_partitioned, write_partitioned
from flowlens.sources.events_adapter import load_events
from flowlens.sources.tables import register_tables
from flowlens.streaming import report_state
from tests.conftest import SF_SMALL


def _files(spark, frame) -> int:
    return frame.select(F.col("_metadata.file_path")).distinct().count()


def test_versions(spark, workdir):
    store = Versions(spark, workdir)
    assert store.current() == Version()
    one = store.commit(Version(), [{"path": "a", "rows": 1}], 5)
    assert store.current() == one == Version(1, ({"path": "a", "rows": 1},), 5)
    with pytest.raises(RuntimeError):
        store.commit(Version(), [], 6)  # a second writer that started from nothing
    # a writer that died half-way leaves no version, and does not block the next
    out = store._fs.create(store._path(f"{workdir}/_versions/0000000002.json"), False)
    out.write(b'{"segments": [')
    out.close()
    assert store.current() == one
    assert store.commit(one, [], 7).number == 3 and store.current().mark == 7


def test_small_tail():
    assert small_tail([], 10) == 0
    assert small_tail([{"rows": 200}, {"rows": 30}, {"rows": 15}], 10) == 2
    rows, segments, rewritten = 0, [], 0
    for _ in range(500):
        n = small_tail(segments, 1)
        moved = sum(s["rows"] for s in segments[len(segments) - n:])
        segments = segments[:len(segments) - n] + [{"rows": 1 + moved}]
        rows, rewritten = rows + 1, rewritten + moved
    assert sum(s["rows"] for s in segments) == 500 and len(segments) <= 10 and rewritten < 500 * 10


def test_fifty_micro_batches_compacted_under_a_follower(spark, workdir):
    events = load_events(spark, SF_SMALL)
    db = "compact_" + workdir.rstrip("/").rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{workdir}/catalog'")
    table, root = f"{workdir}/table", f"{workdir}/compacted"
    rounds = 0
    for _ in sq.compacted_rounds(spark, events, workdir, db, 50, F.date_trunc("year", F.timestamp_millis("produced_at_ts"))):
        rounds += 1
        sink = spark.read.schema(NORMALIZED_SCHEMA).parquet(table)
        view, live = spark.table(f"{db}.normalized_logs"), read_live(spark, table, root)
        columns = NORMALIZED_SCHEMA.fieldNames()
        for rows in (view, live):
            assert rounded(rows.select(columns)).exceptAll(rounded(sink.select(columns))).isEmpty()
            assert rows.count() == sink.count()
        segments = Versions(spark, root).current().paths()
        fewer = sum(_files(spark, spark.read.parquet(p)) for p in segments)
        assert 0 < fewer * 3 < _files(spark, sink)
        # the sink's side of the view opens only what is newer than the segments
        mark = Versions(spark, root).current().mark
        newer = sink.where(F.col("_metadata.file_modification_time") > F.timestamp_micros(F.lit(mark)))
        assert _files(spark, newer) * 3 < _files(spark, sink)
    assert rounds == 2 and sink.count() == events.count()
    assert spark.read.json(f"{workdir}/forward").count() == events.count()
    days = view.where("attack_category = 'Benign'")._jdf.queryExecution().executedPlan().toString()
    assert days.count("PartitionFilters: [isnotnull(attack_category") == len(segments) + 1
    # rows for a day that is compacted already are read all the same, and taken in by the next compaction
    late = f"{workdir}/src/late"
    sq._raw_messages(events.limit(7)).select("value").write.text(late)
    sq._normalizer(spark, f"{workdir}/src", table, f"{workdir}/ckpt/table").awaitTermination()
    spark.catalog.refreshTable(f"{db}.normalized_logs_live")
    assert read_live(spark, table, root).count() == spark.table(f"{db}.normalized_logs").count() == events.count() + 7
    version = compact(spark, table, root, settle_seconds=0)
    assert sum(s["rows"] for s in version.segments) == events.count() + 7 == read_live(spark, table, root).count()
    assert compact(spark, table, root, settle_seconds=0) == version  # nothing new
    publish_view(spark, table, root, database=db)
    assert spark.table(f"{db}.normalized_logs").count() == events.count() + 7
    # batch writers keep away from the sink's folder
    for write in (lambda: write_partitioned(view, table, NORMALIZED_PARTITIONS), lambda: write_batch_partitioned(view, table, NORMALIZED_PARTITIONS, 0)):
        with pytest.raises(ValueError):
            write()


def _flow_table(spark, workdir, steps):
    """Appends each step's normalised rows to a batch table; yields after each."""
    events = load_events(spark, SF_SMALL)
    norm = sq.normalize(sq.raw_flows(events, keep=["ts"]), event_time="event_time")
    _, mid, _ = sq.day_splits(events)
    first = F.col("event_timestamp") < F.lit(mid.isoformat()).cast("timestamp")
    for step in [first, ~first][:steps]:
        own = norm.filter(step)
        own.write.mode("append").partitionBy(*NORMALIZED_PARTITIONS).parquet(f"{workdir}/norm")
        sq.window_metrics(own).write.mode("append").partitionBy(*sq.WINDOW_PARTITIONS).parquet(f"{workdir}/windows")
        yield


def test_second_pass_reads_only_new_files_and_equals_a_full_one(spark, workdir):
    args = (spark, f"{workdir}/norm", f"{workdir}/windows", f"{workdir}/state", f"{workdir}/ckpt", f"{workdir}/reports")
    assert report_state.update_reports(*args) is False
    read, fold = [], report_state.fold_batch

    def watched(batch, batch_id, store, partials):
        if "rollup" in partials:
            read.append((batch_id, batch.count()))
        fold(batch, batch_id, store, partials)
        fold(batch, batch_id, store, partials)  # a batch that is run again adds nothing

    report_state.fold_batch = watched
    try:
        for _ in _flow_table(spark, workdir, 2):
            assert report_state.update_reports(*args)
        rows = spark.read.parquet(f"{workdir}/norm").count()
        assert len(read) == 2 and sum(n for _, n in read) == rows and all(n < rows for _, n in read)
        assert report_state.update_reports(*args) and len(read) == 2  # nothing new, nothing read
    finally:
        report_state.fold_batch = fold
    assert run_reports(spark, f"{workdir}/norm", f"{workdir}/windows", f"{workdir}/full")
    for name in REPORTS:
        a, b = (rounded(read_report(spark, f"{workdir}/{d}", name).drop("generated_at")) for d in ("reports", "full"))
        assert sorted(a.columns) == sorted(b.columns)
        assert a.count() == b.count() > 0 and a.exceptAll(b.select(a.columns)).isEmpty(), name


def test_reports_change_as_one(spark, workdir):
    """A reader sees a whole old or new report; a failed pass leaves the old."""
    root = f"{workdir}/reports"
    frame = lambda n: spark.range(n).selectExpr("'Benign' AS attack_category", "'LOW' AS severity_level", "'unsw' AS dataset_source", "id AS event_count")
    baseline = spark.range(1).selectExpr("id AS benign_count")
    publish_reports(spark, {"attack_distribution": frame(3), "benign_baseline": baseline}, root)
    db = "atomic_" + workdir.rstrip("/").rsplit("-", 1)[-1]
    for path in (f"{workdir}/n", f"{workdir}/w"):
        Versions(spark, path).commit(Version(), [], None)  # the folders exist, without a partition
    register_tables(spark, f"{workdir}/n", f"{workdir}/w", reports_path=root, database=db, location=f"{workdir}/catalog")
    table = spark.table(f"{db}.report_attack_distribution")
    reader = read_report(spark, root, "attack_distribution")
    assert reader.count() == table.count() == 3
    broken = frame(4).withColumn("event_count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        publish_reports(spark, {"attack_distribution": frame(9), "hourly_timeseries": broken}, root, db)
    assert read_report(spark, root, "attack_distribution").count() == 3
    old = report_path(spark, root, "attack_distribution")
    publish_reports(spark, {"attack_distribution": frame(5), "benign_baseline": baseline.limit(0)}, root, db)
    assert read_report(spark, root, "attack_distribution").count() == 5
    assert spark.table(f"{db}.report_attack_distribution").count() == 5
    assert reader.count() == 3  # planned on the version before
    assert read_report(spark, root, "benign_baseline").count() == 1  # skipped: the last one stays
    publish_reports(spark, {"attack_distribution": frame(6)}, root, db)
    assert old not in Versions(spark, root).current().paths()
    assert read_report(spark, root, "attack_distribution").count() == 6 and read_report(spark, root, "benign_baseline").count() == 1
