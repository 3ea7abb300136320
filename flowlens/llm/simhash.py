"""SimHash near-duplicates over vantage-point trees.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, shingles of
``k`` words joined by one space (repeats included; the whole sequence where
it is shorter), each hashed by XXH64 (seed 42). A bit is 1 if set in over
half of the hashes. A text without words has fingerprint zero.

Links: two fingerprints link at ``max_bits`` or fewer differing bits. Such a
pair differs in at most ``max_bits // 2`` bits of its lower or of its upper
half, so each half has its own vantage-point tree with that radius; a half's
distances are narrower spread than the radius needs, which is what makes the
triangle bounds prune.

1. Copies collapse: the search runs over distinct fingerprints.
2. A tree for each half is built from a bounded sample of fingerprints
   (``sample_rows``, chosen by hash); its leaves are the shards. A
   fingerprint's home is the leaf that its distances lead to; it also visits
   every leaf that the triangle inequality does not rule out, so each linked
   pair meets in the home of either. Every fingerprint is searched.
3. A shard grows its own tree over its home fingerprints (over the whole
   fingerprint where a half is all alike) down to small leaves, compares
   there by exact distance, and returns a spanning forest of its links, never
   all pairs of a group.
4. The forests' components give each document the smallest id it reaches.

Nulls: a null text has no words; a row with a null id gets a component from
the others. Repeated rows are copies of each other. An empty table gives an
empty table. Extra columns are ignored. A long text is hashed whole in one task, at 8
bytes a shingle besides the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import hash_share, id_and_text, shared_table
from flowlens.llm.components import connected_components
from flowlens.llm.textarrays import U64

SAMPLE_ROWS = 16_384
SHARD_ROWS = 16_384
LEAF_ROWS = 256
_LOW, _ALL = U64(0xFFFFFFFF), U64(0xFFFFFFFFFFFFFFFF)
HALVES = (_LOW, _ALL ^ _LOW)
_LANES = U64(0x0101010101010101)


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of a text's shingles."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts, ends[k - 1:].tolist())]


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose hashes are ``hashes[first[i]:first[i + 1]]``.

    Eight bits are counted at a time in the bytes of a word, over stretches
    of at most 255 hashes, so that no byte overflows.
    """
    count = np.diff(first)
    out = np.zeros(len(count), dtype=U64)
    own = np.flatnonzero(count)
    if not len(own):
        return out
    pieces = -(-count[own] // 255)
    piece_first = np.concatenate([[0], np.cumsum(pieces)])
    at = np.repeat(first[:-1][own], pieces) + 255 * (np.arange(piece_first[-1]) - np.repeat(piece_first[:-1], pieces))
    half = count[own][:, None]
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> U64(shift)) & _LANES, at)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), piece_first[:-1], axis=0)
        for byte in range(8):
            out[own] |= (2 * counts[:, byte] > half[:, 0]).astype(U64) << U64(8 * byte + shift)
    return out


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                hashes, first = [], [0]
                for text in part.column(1).to_pylist():
                    hashes += shingle_hashes(text, k)
                    first.append(len(hashes))
                found = majority_bits(np.array(hashes, dtype=U64), np.array(first))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """``(id, fp)``, the fingerprint as a signed 64-bit integer."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_fingerprints(k), "id bigint, fp bigint")


# ---------------------------------------------------------------- vantage-point trees

def build_tree(points: np.ndarray, radius: int, leaf_rows: int):
    """A tree over distinct ``points``: ``None`` for a leaf, else (vantage
    point, bound, inside, outside); inside holds distances up to the bound."""
    if len(points) <= leaf_rows:
        return None
    best = None
    for point in points[:: max(1, len(points) // 8)][:8]:
        far = np.bitwise_count(points ^ point)
        low, high = int(np.quantile(far, 0.3)), int(np.quantile(far, 0.7))
        for bound in range(low, high + 1):
            inside = int((far <= bound).sum())
            if 0 < inside < len(points):
                met = int((far <= bound + radius).sum()) + int((far + radius > bound).sum())
                score = met / min(inside, len(points) - inside)
                if best is None or score < best[0]:
                    best = (score, point, bound, far)
    if best is None:
        return None
    _, point, bound, far = best
    return point, bound, build_tree(points[far <= bound], radius, leaf_rows), build_tree(points[far > bound], radius, leaf_rows)


def route(tree, points: np.ndarray, radius: int):
    """For each leaf in order: (indices of visitors, which of them are at home)."""
    def walk(node, at, home):
        if node is None:
            yield at, home
            return
        point, bound, inside, outside = node
        far = np.bitwise_count(points[at] ^ point).astype(np.int64)
        near = far <= bound
        into = far - radius <= bound
        yield from walk(inside, at[into], (home & near)[into])
        into = far + radius > bound
        yield from walk(outside, at[into], (home & ~near)[into])

    yield from walk(tree, np.arange(len(points)), np.ones(len(points), dtype=bool))


class Forest:
    """Union-find over array positions; the root is the smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, at: np.ndarray) -> np.ndarray:
        root = self.parent[at]
        while not np.array_equal(up := self.parent[root], root):
            root = up
        return root

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.find(a), self.find(b)
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def link_close(points: np.ndarray, at: np.ndarray, home: np.ndarray, tries: list[tuple[np.uint64, int]], max_bits: int, forest: Forest, leaf_rows: int = LEAF_ROWS) -> None:
    """Link every home point of ``at`` with the points of ``at`` within
    ``max_bits``. ``tries``: (mask, radius) of the trees to prune with, in turn."""
    own = at[home]
    if not len(own):
        return
    if tries and len(own) > leaf_rows:
        mask, radius = tries[0]
        tree = build_tree(np.unique(points[own] & mask), radius, leaf_rows // 2)
        if tree is not None:
            for visits, stays in route(tree, points[at] & mask, radius):
                link_close(points, at[visits], home[visits] & stays, tries[1:], max_bits, forest, leaf_rows)
            return
        link_close(points, at, home, tries[1:], max_bits, forest, leaf_rows)
        return
    step = max(1, (1 << 20) // len(at))
    theirs = points[at]
    for start in range(0, len(own), step):
        part = own[start:start + step]
        i, j = np.nonzero(np.bitwise_count(points[part][:, None] ^ theirs[None, :]) <= max_bits)
        forest.link(part[i], at[j])


def _deal(trees, radius: int):
    """Rows (shard, fp, home): a fingerprint's home and visits in the trees of both halves."""
    def run(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
            shard = 0
            for mask, tree in zip(HALVES, trees.value):
                for at, home in route(tree, points & mask, radius):
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), shard)), pa.array(points[at].view(np.int64)), pa.array(home)],
                            names=["shard", "fp", "home"])
                    shard += 1

    return run


def _leaves(tree) -> int:
    return 1 if tree is None else _leaves(tree[2]) + _leaves(tree[3])


def _link_shard(first_of_upper: int, max_bits: int):
    def run(table: pa.Table) -> pa.Table:
        fp, home = table["fp"].to_numpy(), table["home"].to_numpy()
        order = np.argsort(fp)
        fp, home = fp[order], home[order]
        mask = HALVES[int(table["shard"][0].as_py() >= first_of_upper)]
        forest = Forest(len(fp))
        link_close(fp.view(U64), np.arange(len(fp)), home, [(mask, max_bits // 2), (_ALL, max_bits)], max_bits, forest)
        root = forest.find(np.arange(len(fp)))
        linked = root != np.arange(len(fp))
        return pa.table({"a": fp[linked], "b": fp[root[linked]]})

    return run


def fingerprint_links(distinct: DataFrame, max_bits: int = 3, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A spanning set of links (``a``, ``b``) between the distinct fingerprints of column ``fp``."""
    spark = distinct.sparkSession
    n = max(distinct.count(), 1)
    sample = (distinct.select("fp").where(hash_share(F.xxhash64("fp"), sample_rows, F.lit(n)))
              .orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).toArrow()["fp"].to_numpy().view(U64))
    leaf = max(8, -(-len(sample) * shard_rows // n))
    radius = max_bits // 2
    trees = [build_tree(np.unique(sample & mask), radius, leaf) for mask in HALVES]
    dealt = distinct.select("fp").mapInArrow(_deal(spark.sparkContext.broadcast(trees), radius), "shard bigint, fp bigint, home boolean")
    return dealt.groupBy("shard").applyInArrow(_link_shard(_leaves(trees[0]), max_bits), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, max_bits: int = 3,
                       sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(id, fp, component)``, one row a document; ``component`` is the smallest id it reaches."""
    prints = shared_table(fingerprints(docs, id_col, text_col, k), "fingerprints")
    distinct = shared_table(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = connected_components(fingerprint_links(distinct, max_bits, sample_rows, shard_rows))
    labelled = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first").alias("component"))
    return prints.join(labelled.join(least, "root").select("fp", "component"), "fp").select("id", "fp", "component")
