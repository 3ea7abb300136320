"""Connected components of a table of edges, by alternating star operations.

Large-star links every larger neighbour of a node to the least of its
neighbourhood; small-star does so for the smaller neighbours. Repeated, the
edges become one star a component whose centre is its smallest node.

A hub's edges are never gathered: they are split by a hash of the other end
into ``salts`` parts, whose number grows with the edges so that a part holds
some ``PART_ROWS`` of them at most (one part, where there are no more edges).
The least neighbour is a minimum of the
parts' minima, handed back to each part. Each round's edges are written to the
shared folder, which cuts the lineage. Nodes may be of any ordered type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import remove_table, shared_table


PART_ROWS = 1 << 14


def _with_least(rows: DataFrame, salts: int) -> DataFrame:
    """``rows (a, b)`` with ``m``, the least ``b`` of each ``a``."""
    if salts == 1:
        return rows.join(rows.groupBy("a").agg(F.min("b").alias("m")), "a").select("a", "b", "m")
    salted = rows.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(salts)))
    parts = salted.groupBy("a", "s").agg(F.min("b").alias("m"))
    handed = parts.select("a", "s").join(parts.groupBy("a").agg(F.min("m").alias("m")), "a")
    return salted.join(handed, ["a", "s"]).select("a", "b", "m")


def _large_star(edges: DataFrame, salts: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both, salts).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, salts: int) -> DataFrame:
    near = _with_least(edges, salts)
    moved = near.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(near.where(F.col("b") == F.col("m")).select("a", "b")).dropDuplicates()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one edge, to a centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("edges"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("edges"), F.lit(1).alias("centre")))
    nodes = ends.groupBy("node").agg(F.sum("edges").alias("edges"), F.max("centre").alias("centre"))
    return nodes.where(F.col("edges") + F.col("centre") > 1).isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge that is not its component's
    smallest; rows with a null end and loops are no edges."""
    x, y = F.col(a), F.col(b)
    now = shared_table(edges.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).dropDuplicates(), "edges")
    while not _is_stars(now):
        salts = -(-now.count() // PART_ROWS)
        before, now = now, shared_table(_small_star(_large_star(now, salts), salts), "edges")
        remove_table(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
