"""Merkle manifest of a dataset, by a nested-struct rollup of rank digits.

A row's leaf is the SHA-256 of its fields, each written as its UTF-8 length,
``:`` and its value, or ``-`` where it is null. The leaves of a group ascend
by id; every 16 consecutive nodes become the digest of their digests (as hex
text) while a level has more than one node. The groups' roots, by group, are
the leaves of one more such tree.

1. Ranks: leaves are dealt by range of (group, id, leaf) and sorted, so a hot
   group spreads over as many tasks as it fills. A row's rank is its place in
   its task's stretch of the group plus the sizes of the stretches before it.
2. Rollup: the rank's base-16 digits are columns. Blocks of ``16^LEVELS``
   leaves are dealt once; in a block one digit after the other is grouped
   away, the nodes below nested as an array of structs. Block roots are ranked
   by their block number: they are the leaves of the next tier, so no row ever
   holds more than one block.
3. Proofs: from the top tier down, a block's row is exploded level by level; a
   node's siblings are read off the array it stands in and put before the path
   of the nodes above. Blocks and the paths above them meet by grouping on the
   block, not by a join.

Null ids come first in their group, null groups before all others. Rows that
repeat an id are ordered by their leaf digest; equal rows are leaves of their
own. Texts of any length are hashed whole; empty texts count as ``0:``. Extra
columns are ignored. An empty table gives an empty manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import shared_table

BITS = 4
FAN_OUT = 1 << BITS
LEVELS = 3
_PATH = "array<struct<left: string, right: string>>"


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 (hex) of the fields' lengths and values."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts
    ]), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order`` in its group) and ``n``, the group's rows."""
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = shared_table(spread.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    # one row for each group of a task: at most groups + tasks of them
    runs = placed.groupBy(group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    own = Window.partitionBy(group)
    runs = runs.select(group, "__part", "__first", F.sum("__rows").over(own).alias("n"),
                       (F.sum("__rows").over(own.orderBy("__part")) - F.col("__rows")).alias("__before"))
    return placed.join(runs, [group, "__part"]).select(
        *rows.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("rank"), "n")


def _digests(kids: str) -> Column:
    return F.transform(kids, lambda k: k["h"])


def _roll_up(nodes: DataFrame, tier: int, payload: list[str]) -> DataFrame:
    """One row a block of ``nodes`` (grp, n, rank, h): its root ``h`` and the nested ``kids``."""
    digits = [F.shiftright("rank", BITS * j).bitwiseAND(F.lit(FAN_OUT - 1)).alias(f"d{j}") for j in range(LEVELS)]
    block = F.shiftright("rank", BITS * LEVELS).alias("block")
    rows = nodes.select("grp", "n", block, *digits, "h", *payload).repartition("grp", "block")
    for level in range(LEVELS):
        keys = ["grp", "n", "block", *[f"d{j}" for j in range(level + 1, LEVELS)]]
        node = F.struct(F.col(f"d{level}").alias("d"), "h", *(payload if level == 0 else ["kids"]))
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(node)).alias("kids"))
        # a level of one node is no level: the node stays as it is
        many = F.col("n") > FAN_OUT ** (tier * LEVELS + level)
        rows = rows.withColumn("h", F.when(many, F.sha2(F.array_join(_digests("kids"), ""), 256)).otherwise(F.col("kids")[0]["h"]))
    return rows


def _tiers(nodes: DataFrame, payload: list[str], name: str) -> list[DataFrame]:
    """The tiers of every group's tree, leaves first; the last has one block a group."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out = [shared_table(_roll_up(nodes, 0, payload), f"{name}_0")]
    while most > FAN_OUT ** (LEVELS * len(out)):
        upper = out[-1].select("grp", "n", F.col("block").alias("rank"), "h")
        out.append(shared_table(_roll_up(upper, len(out), []), f"{name}_{len(out)}"))
    return out


def _unfold(tiers: list[DataFrame], above: DataFrame, payload: list[str]) -> DataFrame:
    """Every leaf with ``path``, ``subroot`` and ``root``; ``above`` holds them for each last block."""
    handed = ["path", "subroot", "root"]
    for tier in reversed(range(len(tiers))):
        blocks = tiers[tier].select("grp", "block", "n", "kids")
        met = blocks.unionByName(above, allowMissingColumns=True).groupBy("grp", "block")
        rows = met.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", *handed)]).withColumnRenamed("block", "rank")
        for level in reversed(range(LEVELS)):
            rows = rows.select("grp", "n", "rank", *handed, _digests("kids").alias("run"), F.posexplode("kids").alias("i", "node"))
            sides = F.struct(F.array_join(F.expr("slice(run, 1, i)"), "").alias("left"),
                             F.array_join(F.expr(f"slice(run, i + 2, {FAN_OUT})"), "").alias("right"))
            many = F.col("n") > FAN_OUT ** (tier * LEVELS + level)
            inner = [F.col("node.h"), *[F.col(f"node.{c}") for c in payload if tier == 0]] if level == 0 else [F.col("node.kids")]
            rows = rows.select("grp", "n", (F.col("rank") * FAN_OUT + F.col("i")).alias("rank"),
                               F.when(many, F.concat(F.array(sides), "path")).otherwise(F.col("path")).alias("path"),
                               "subroot", "root", *inner)
        above = rows.select("grp", F.col("rank").alias("block"), *handed)
    return rows


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def merkle_manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source",
                    found: dict[str, Column] | None = None) -> DataFrame:
    """One row a document: ``id``, ``leaf``, ``path`` (the siblings left and
    right of its node, leaf level first), ``subroot`` (its group's), ``root``,
    ``folded_root`` and ``verified``.

    ``found`` gives values of fields as they are met at verification (default:
    as in ``docs``; a null Column value is a null field). The leaf of those is
    folded along the path; the row is verified if that gives ``root``."""
    met = found or {}
    changed = F.lit(False) if not met else F.lit(True)
    leaf = leaf_digest([F.col(c) for c in fields])
    seen = F.when(changed, leaf_digest([met.get(c, F.col(c)) for c in fields]))
    grp = F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit(""))  # null first, then bytewise
    leaves = shared_table(docs.select(F.col(id_col).alias("id"), grp.alias("grp"), leaf.alias("h"), seen.alias("seen")), "leaves")
    trees = _tiers(ranked(leaves, "grp", ["id", "h"]), ["id", "seen"], "leaves")
    subroots = trees[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "h")
    top = _tiers(ranked(subroots, "grp", ["of"]), ["of"], "groups")
    none = F.array().cast(_PATH).alias("path")
    crown = top[-1].select("grp", "block", none, F.lit(None).cast("string").alias("subroot"), F.col("h").alias("root"))
    groups = _unfold(top, crown, ["of"])
    above = groups.select(F.col("of").alias("grp"), F.lit(0).cast("bigint").alias("block"), "path", F.col("h").alias("subroot"), "root")
    out = _unfold(trees, above, ["id", "seen"])
    folded = fold(F.coalesce("seen", "h"), F.col("path")).alias("folded_root")
    out = out.select("id", F.col("h").alias("leaf"), "path", "subroot", "root", folded)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
