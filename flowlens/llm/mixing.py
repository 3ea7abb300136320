"""Mixing sources to target weights by the cube method of balanced sampling.

A source's target is its share, by weight, of ``share`` times all words, at
most ``cap`` times its own words; what is cut off goes to the other sources
by weight until none is above its cap. A document of a source with ratio
``r = target / words`` is taken ``floor(r)`` times, and once more with
probability ``r - floor(r)``.

The extra copies are drawn by the cube method. The inclusion probabilities
are moved along vectors of the null space of the constraints (number of
documents and number of words, per source), each step fixing one document
at 0 or 1 while both totals stay exact (flight, three documents at a time).
A source is cut into buckets by a hash of the id, so a hot source is many
tasks; each bucket leaves at most two open documents, which meet in the next
level's buckets until one bucket a source is left. Its at most two open
documents are settled by the linear program of the landing phase (the
outcome distribution with the right marginals and the least expected
deviation).

Draws are seeded by source, level and bucket, so reruns agree. Nulls: a null
text has 0 words; a null source is a source of its own, ordered last; null
ids form units like others. A repeated row is a unit of its own. A document
of a source without words is taken once. An empty table gives an empty table.
The table of sources (one row each) is ranked in one sorted window. Of a long
text only its number of words is kept. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import WORD_PATTERN, shared_table

WEIGHTS = (5, 2, 1)
BUCKET_ROWS = 4_000
FAN_IN = 5_000
_EPS = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row a source: ``source``, ``source_size``, ``n_docs``, ``target``, ``ratio``.

    Sources sorted by cap over weight fill up in that order: a source is at
    its cap if filling all sources to its level needs no more than there is.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    ranked = (total.withColumn("weight", weight).withColumn("cap", F.lit(cap) * F.col("source_size"))
              .withColumn("level", F.col("cap") / F.col("weight")))
    whole = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.select(
        "*", (F.lit(share) * F.sum("source_size").over(whole)).alias("budget"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("weight_from"))
    full = sums.withColumn("full", F.col("cap_before") + F.col("level") * F.col("weight_from") <= F.col("budget"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * left / open_weight)
    return (full.withColumn("target", target)
            .select("source", "source_size", "n_docs", "target",
                    F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)).alias("ratio")))


# ---------------------------------------------------------------- the cube method, within one bucket

def _step(p: list[float], at: list[int], u: list[float], draw: float) -> None:
    """Move ``p`` along ``u`` or against it, to where the first unit is settled, without bias."""
    up = min(((1 - p[i]) / d if d > 0 else -p[i] / d) for i, d in zip(at, u) if d)
    down = min((p[i] / d if d > 0 else (p[i] - 1) / d) for i, d in zip(at, u) if d)
    move = up if draw * (up + down) < down else -down
    for i, d in zip(at, u):
        x = p[i] + move * d
        p[i] = 0.0 if x < _EPS else 1.0 if x > 1 - _EPS else x


def cube_flight(p: list[float], sizes: list[int], draws) -> list[int]:
    """Settle units of ``p`` (in place) keeping the sums of ``p`` and of
    ``p * sizes``; returns the places of the at most two open units."""
    active: list[int] = []
    for nxt in range(len(p)):
        if 0 < p[nxt] < 1:
            active.append(nxt)
        while len(active) == 3:
            a, b, c = (sizes[i] for i in active)
            u = [float(b - c), float(c - a), float(a - b)] if not a == b == c else [1.0, -1.0, 0.0]
            _step(p, active, u, next(draws))
            active = [i for i in active if 0 < p[i] < 1]
    while len(active) == 2 and sizes[active[0]] == sizes[active[1]]:
        _step(p, active, [1.0, -1.0], next(draws))
        active = [i for i in active if 0 < p[i] < 1]
    return active


def cube_landing(p: list[float], sizes: list[int], active: list[int], draws) -> None:
    """Settle the last one or two units: the distribution over their outcomes
    with marginals ``p`` that minimises the expected deviation of the totals."""
    if len(active) == 1:
        i = active[0]
        p[i] = 1.0 if next(draws) < p[i] else 0.0
    elif active:
        i, j = active
        scale = (sizes[i] + sizes[j]) or 1
        cost = {(s, t): abs(sizes[i] * (s - p[i]) + sizes[j] * (t - p[j])) / scale + abs(s - p[i] + t - p[j]) / 2
                for s in (0, 1) for t in (0, 1)}
        low, high = max(0.0, p[i] + p[j] - 1), min(p[i], p[j])
        both = low if cost[1, 1] + cost[0, 0] > cost[1, 0] + cost[0, 1] else high
        x, out = next(draws), (0.0, 0.0)
        for outcome, chance in (((1.0, 1.0), both), ((1.0, 0.0), p[i] - both), ((0.0, 1.0), p[j] - both)):
            if x < chance:
                out = outcome
                break
            x -= chance
        p[i], p[j] = out


def _draws(*seed):
    rng = np.random.default_rng(xxhash.xxh64_intdigest("|".join(map(repr, seed)).encode()))
    while True:
        yield from rng.random(1024).tolist()


def _settle(seed: int, level: int, last: bool):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("id", "ascending")])
        p, sizes = table["p"].to_pylist(), table["size"].to_pylist()
        draws = _draws(seed, table["source"][0].as_py(), level, table["bucket"][0].as_py())
        active = cube_flight(p, sizes, draws)
        if last:
            cube_landing(p, sizes, active, draws)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


_UNITS = "source string, id bigint, size bigint, source_size bigint, target double, copies bigint, p double, bucket bigint"


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 7,
                bucket_rows: int = BUCKET_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """One row a document: ``id``, ``size`` (words), ``source_size``, ``target``
    (its source's), ``copies`` (times it is taken), ``taken`` (words taken)."""
    sizes = shared_table(docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size")), "sizes")
    targets = shared_table(source_targets(sizes, weights, share, cap), "targets")
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    n_buckets = F.ceil(F.col("n_docs") / bucket_rows).cast("bigint")
    units = (sizes.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
             .select("u.source", "id", "size", "source_size", "target", F.floor("ratio").alias("copies"),
                     (F.col("ratio") - F.floor("ratio")).alias("p"),
                     F.pmod(F.xxhash64(F.coalesce("id", F.lit(-1)), F.lit(seed)), n_buckets).alias("bucket")))
    level, widest, done = 0, -(-most // bucket_rows), []
    todo = units
    while True:
        last = widest <= 1
        todo = shared_table(todo.groupBy("source", "bucket").applyInArrow(_settle(seed, level, last), _UNITS), f"level{level}")
        settled = (F.col("p") <= 0) | (F.col("p") >= 1)
        done.append(todo.where(settled))
        if last:
            break
        todo = todo.where(~settled).withColumn("bucket", F.floor(F.col("bucket") / fan_in))
        widest, level = -(-widest // fan_in), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = (F.col("copies") + F.col("p").cast("bigint")).alias("copies")
    return out.select("id", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))
