"""Mergeable distinct counts, in batch and on a stream."""

from pyspark.sql import functions as F

from flowlens.operators.sketches import distinct_counts, merge_sketches, relative_error, window_sketches


def _flows(spark):
    rows = spark.range(60_000).selectExpr(
        "timestamp_seconds(1704067200 + id % 172800) AS event_timestamp", "if(id % 3 = 0, 'unsw', 'cicids') AS dataset_source",
        "concat('10.0.', id % 20011) AS src_ip", "if(id % 10 = 0, null, id % 500) AS dst_port", "cast(null as string) AS label")
    return rows


def test_days_from_five_minute_windows(spark):
    flows = _flows(spark)
    windows = window_sketches(flows)
    days = distinct_counts(merge_sketches(merge_sketches(windows, "1 hour"), "1 day")).collect()
    exact = {(r.w, r.dataset_source): r for r in flows.groupBy(F.date_trunc("day", "event_timestamp").alias("w"), "dataset_source").agg(
        F.count_distinct("src_ip").alias("src_ip"), F.count_distinct("dst_port").alias("dst_port"), F.count("*").alias("n")).collect()}
    assert len(days) == len(exact) == 2
    for r in days:
        e = exact[r.window_start, r.dataset_source]
        assert r.event_count == e.n and r.unique_label == 0
        assert abs(r.unique_src_ip - e.src_ip) <= 4 * relative_error() * e.src_ip
        assert abs(r.unique_dst_port - e.dst_port) <= 4 * relative_error() * e.dst_port
    # merging in one step: the same groups, and counts within the same error (an estimate depends a little on the order of merges)
    for r in distinct_counts(merge_sketches(windows, "1 day")).collect():
        e = exact[r.window_start, r.dataset_source]
        assert r.event_count == e.n and abs(r.unique_src_ip - e.src_ip) <= 4 * relative_error() * e.src_ip


def test_sketches_on_a_stream(spark, workdir):
    """Closed windows of a stream hold the sketches that batch gives."""
    flows = _flows(spark).where("event_timestamp < '2024-01-01 01:00:00'")
    flows.write.parquet(f"{workdir}/src")
    stream = spark.readStream.schema(flows.schema).parquet(f"{workdir}/src").withWatermark("event_timestamp", "2 minutes")
    q = (window_sketches(stream).writeStream.format("parquet").option("path", f"{workdir}/out")
         .option("checkpointLocation", f"{workdir}/ck").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    got = {(r.window_start, r.dataset_source): r for r in distinct_counts(spark.read.parquet(f"{workdir}/out")).collect()}
    want = {(r.window_start, r.dataset_source): r for r in
            distinct_counts(window_sketches(flows)).where("window_end <= '2024-01-01 00:55:00'").collect()}
    assert got.keys() == want.keys() and len(got) == 22
    for key, r in got.items():
        assert r.event_count == want[key].event_count
        assert abs(r.unique_src_ip - want[key].unique_src_ip) <= 4 * relative_error() * want[key].unique_src_ip
