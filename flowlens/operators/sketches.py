"""Distinct counts that merge over time.

A distinct count of one window says nothing about a day; a sketch does. Each
window keeps a HyperLogLog sketch of each counted column (``2^lg_k`` registers,
so of fixed size however many values it has seen); sketches of windows merge to
hours and days without going back to the flows. The relative standard error of
a merged count is about ``1.04 / 2^(lg_k / 2)``: 1.6 % at the default.

The same aggregate runs on a stream (with a watermark), where a group's state is
its sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
DEFAULT_COUNTED = ("src_ip", "dst_port", "label")


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a merged count."""
    return 1.04 / 2 ** (lg_k / 2)


def window_sketches(flows: DataFrame, width: str = "5 minutes", keys=("dataset_source",), counted=DEFAULT_COUNTED,
                    time_col: str = "event_timestamp", lg_k: int = LG_K) -> DataFrame:
    """One row a window and key: ``event_count`` and a ``sketch_<column>`` of each
    counted column (null where all its values are)."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"sketch_{c}") for c in counted]
    return (flows.groupBy(F.window(F.col(time_col), width).alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias("event_count"), *sketches)
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "event_count",
                    *[f"sketch_{c}" for c in counted]))


def merge_sketches(windows: DataFrame, width: str, keys=("dataset_source",), counted=DEFAULT_COUNTED) -> DataFrame:
    """The windows of ``window_sketches``, or of an earlier merge, merged to
    ``width`` (a multiple of theirs)."""
    merged = [F.hll_union_agg(f"sketch_{c}").alias(f"sketch_{c}") for c in counted]
    return (windows.groupBy(F.window(F.col("window_start"), width).alias("window"), *keys)
            .agg(F.sum("event_count").alias("event_count"), *merged)
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "event_count",
                    *[f"sketch_{c}" for c in counted]))


def distinct_counts(windows: DataFrame, counted=DEFAULT_COUNTED) -> DataFrame:
    """``unique_<column>`` in place of the sketches; 0 where there was no value."""
    kept = [c for c in windows.columns if not c.startswith("sketch_")]
    return windows.select(*kept, *[F.coalesce(F.hll_sketch_estimate(f"sketch_{c}"), F.lit(0)).alias(f"unique_{c}") for c in counted])
