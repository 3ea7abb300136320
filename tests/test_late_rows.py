"""The gate ahead of windowed aggregates: late rows by the watermark's rule."""

from pyspark.sql import functions as F

from flowlens.plans import stream_queries as sq
from flowlens.schemas import UNIFIED_SCHEMA
from flowlens.session import default_parallelism
from flowlens.sinks.versions import Versions
from flowlens.sources.events_adapter import load_events
from flowlens.streaming import jobs
from flowlens.streaming.late_rows import GateTotals, gate_batch, gate_totals, kept_rows, late_rows
from tests.conftest import SF_SMALL


def _rows(spark, *times):
    rows = spark.createDataFrame([(t,) for t in times], "t string")
    return rows.select(*[F.to_timestamp("t").alias(f.name) if f.name == "event_timestamp" else F.lit("a").cast(f.dataType).alias(f.name)
                         if f.name == "src_ip" else F.lit(None).cast(f.dataType).alias(f.name) for f in UNIFIED_SCHEMA.fields])


def test_gate_decides_by_the_batches_before(spark, workdir):
    store = Versions(spark, f"{workdir}/gate")
    gate = lambda n, *times: gate_batch(_rows(spark, *times), n, store, "5 minutes", "2 minutes")
    gate(0, "2024-01-01 10:00:00", "2024-01-01 08:00:00", None)  # nothing came before: nothing is late
    assert gate_totals(spark, store.root) == GateTotals(2, 0, 1, 1704103200000000)
    # the watermark is 09:58: a window that ended at 09:55 is closed, the one that ends at 10:00 is not
    gate(1, None, "2024-01-01 09:54:59", "2024-01-01 09:55:00", "2024-01-01 12:00:00")
    gate(1, "2024-01-01 09:54:59", "2024-01-01 09:55:00", "2024-01-01 12:00:00")  # the batch once more
    assert gate_totals(spark, store.root) == GateTotals(4, 1, 2, 1704110400000000)
    # of a batch that stopped before its commit, the next run's rows replace what it wrote
    again = Versions(spark, f"{workdir}/gate")
    gate_batch(_rows(spark, "2024-01-01 12:01:00"), 2, again, "5 minutes", "2 minutes")
    again._fs.delete(again._files()[-1], False)
    gate(2, "2024-01-01 12:01:00")
    assert gate_totals(spark, store.root).kept == 5
    late = late_rows(spark, store.root).select("late_reason", "batch_id").collect()
    assert sorted(map(tuple, late)) == [("BEHIND_WATERMARK", 1), ("NO_EVENT_TIME", 0), ("NO_EVENT_TIME", 1)]
    # a window aggregate over the kept rows drops none of them
    q = jobs.start_window_table(kept_rows(spark, store.root), f"{workdir}/windows", f"{workdir}/ck", trigger=sq.AVAILABLE_NOW, state_partitions=2)
    q.awaitTermination()
    assert q.exception() is None
    assert sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"]) == 0


def test_gate_reads_a_batch_once(spark, workdir):
    """The totals come from the rows written; the messages are read and decoded for the write alone."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = _rows(spark, "2024-01-01 10:00:00", "2024-01-01 08:00:00", None)
    store = Versions(spark, f"{workdir}/gate")
    gate_batch(rows.mapInArrow(count, rows.schema), 0, store, "5 minutes", "2 minutes")
    assert seen.value == 3 and gate_totals(spark, store.root) == GateTotals(2, 0, 1, 1704103200000000)
    gate_batch(rows.limit(0), 1, store, "5 minutes", "2 minutes")  # a batch without rows
    assert gate_totals(spark, store.root) == GateTotals(2, 0, 1, 1704103200000000)


def test_messages_are_written_by_all_cores(spark, workdir):
    events = load_events(spark, SF_SMALL).coalesce(1)
    written = []
    sq.run_steps(events, [F.lit(True)], lambda own: written.append(own) or sq._unified_messages(own), lambda: _Done(), f"{workdir}/src")
    assert written[0].select(F.spark_partition_id()).distinct().count() == default_parallelism(spark) > 1


class _Done:
    def awaitTermination(self):  # noqa: N802
        pass

    def exception(self):
        pass
