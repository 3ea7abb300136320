"""N-gram Jaccard join: a blocked sparse product of documents by n-grams.

Documents are the rows and ``k``-word shingles the columns of a 0/1 matrix
``A``; the overlaps of all pairs are ``A`` times its transpose. Two documents
link if ``100 * intersection >= percent * union`` of their shingle sets. The
product is never written out; bounds from the documents' sizes decide which of
its entries are worked out.

1. Documents with equal sets are one class, known by two 64-bit sums over its
   set; the join runs over classes. Copies cost one row each, no pairs.
2. Columns are ordered by a count of each shingle over all documents, rare
   first (a table of ``slots`` counts, so its size is fixed; shingles that
   share a slot share a count, and any order gives whole results). Linked sets
   of ``n`` and ``m`` shingles share ``percent (n + m) / (100 + percent)``, so
   both have a common column among their first ``n - ceil(percent n / 100) + 1``.
   Only those entries of ``A`` are multiplied.
3. The entries are dealt by range of (column, class) and sorted: a hot column
   spreads over many tasks, where it is worked on in blocks of ``block`` rows.
   A pair in a column is discarded if the shingles from that column on, of
   either, are fewer than the overlap it needs; or if the sum over 32 blocks of
   columns of the lesser block size is. Pairs of one component are left out.
4. First a block's least class by a seeded hash is paired with the others of
   the block, the pairs left are counted exactly, and linked classes become
   components; again with another seed while that links many. What remains
   apart is then multiplied whole: all pairs in a block, and all pairs of
   blocks of a column that holds several, so no link is lost.
5. The overlap of each remaining pair is counted over the whole sets.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text of fewer than
``k`` words has its whole sequence as its only shingle. Shingles are compared
by 64-bit hash. Texts without words (null, empty) are in no link: their
component is their own id. A null id is never the least; rows that repeat an id
are documents of their own. Long texts are worked on whole; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import id_and_text, remove_table, shared_table
from flowlens.llm.components import connected_components
from flowlens.llm.decontam import shingle_rows
from flowlens.llm.textarrays import U64, Words, chunks, mix, text_buffers

SLOTS = 1 << 20
BLOCK_ROWS = 2_048
BANDS = 32
FILTER_BITS = 23
#: Contraction goes on while a round links over one in so many classes.
MANY_LINKS = 200
_PARTS = 16  # of the table of counts, as rows
_FULL = 255
_KEY = ["hi", "lo"]


# ---------------------------------------------------------------- sets

def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the ``n + 1`` bounds of the texts."""
    h, text, _, _ = shingle_rows(Words(data, offsets), k)
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(offsets)))


def set_keys(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set; zero for an empty one."""
    out = []
    for salt in (U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)):
        run = np.zeros(len(h) + 1, dtype=U64)
        np.cumsum(mix(h ^ salt), dtype=U64, out=run[1:])
        out.append((run[first[1:]] - run[first[:-1]]).view(np.int64))
    return out[0], out[1]


def band_sizes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes of each set's parts by the leading bits of the hash."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    count = np.bincount(text * BANDS + (h >> U64(64 - int(math.log2(BANDS)))).astype(np.int64), minlength=n * BANDS)
    return np.minimum(count, _FULL).astype(np.uint8).reshape(n, BANDS)


def _slots(h: np.ndarray, slots: int) -> np.ndarray:
    return (mix(h) & U64(slots - 1)).astype(np.int64)


def _describe(k: int, slots: int):
    """A row a document, and at the end the task's table of counts in parts."""
    names = ["id", "hi", "lo", "n", "bands", "part", "counts"]

    def run(batches):
        table = np.zeros(slots, dtype=np.uint32)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for begin, end, part, bounds in chunks(data, offsets):
                h, first = shingle_sets(part, bounds, k)
                np.add.at(table, _slots(h, slots), 1)
                hi, lo = set_keys(h, first)
                m = end - begin
                bands = pa.array([x.tobytes() for x in band_sizes(h, first)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, m), pa.array(hi), pa.array(lo), pa.array(np.diff(first)), bands,
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        parts = [zlib.compress(x.tobytes(), 1) for x in table.reshape(_PARTS, -1)]
        none = [pa.nulls(_PARTS, pa.int64())] * 4 + [pa.nulls(_PARTS, pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(_PARTS), pa.int32()), pa.array(parts, pa.binary())], names=names)

    return run


def _added(table: pa.Table) -> pa.Table:
    total = None
    for x in table["counts"].to_pylist():
        x = np.frombuffer(zlib.decompress(x), np.uint32)
        total = x.copy() if total is None else np.minimum(total.astype(np.uint64) + x, 0xFFFFFFFF).astype(np.uint32)
    return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _counts(described: DataFrame, slots: int) -> np.ndarray:
    """The sum of the tasks' tables, 64 at a time."""
    parts = described.where("counts IS NOT NULL").select("part", "counts")
    n = parts.count() // _PARTS
    while n > 1:
        n = -(-n // 64)
        group = F.pmod(F.xxhash64("counts"), F.lit(n))
        parts = shared_table(parts.withColumn("g", group).groupBy("part", "g").applyInArrow(_added, "part int, counts binary"), "counts")
    rows = parts.groupBy("part").applyInArrow(_added, "part int, counts binary").toArrow().sort_by("part")
    if not rows.num_rows:
        return np.zeros(slots, np.uint32)
    return np.concatenate([np.frombuffer(zlib.decompress(x), np.uint32) for x in rows["counts"].to_pylist()])


# ---------------------------------------------------------------- entries of the matrix

def needed(n, m, percent: int):
    """Least overlap at which sets of ``n`` and ``m`` link."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


def _entries(counts, k: int, percent: int, least: int):
    """Rows (g, hi, pos): the first columns of each class that a task meets."""
    names = ["g", "hi", "pos"]

    def run(batches):
        table = counts.value
        seen = set()
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for _, _, part, bounds in chunks(data, offsets):
                h, first = shingle_sets(part, bounds, k)
                hi, lo = set_keys(h, first)
                size = np.diff(first)
                fresh = np.zeros(len(size), dtype=bool)
                for i in np.flatnonzero(size >= least).tolist():
                    key = (int(hi[i]), int(lo[i]))
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                text = np.repeat(np.arange(len(size)), size)
                pick = fresh[text]
                h, text = h[pick], text[pick]
                order = np.lexsort((h, table[_slots(h, len(table))], text))
                h, text = h[order], text[order]
                pos = np.arange(len(h)) - np.searchsorted(text, text)
                keep = pos < (size - (percent * size + 99) // 100 + 1)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[keep].view(np.int64)), pa.array(hi[text[keep]]), pa.array(pos[keep].astype(np.int32))], names=names)

    return run


def _runs(batches, block_rows: int):
    """Stretches of sorted rows that end with a column: (table, whether its
    first and its last column may go on in another stretch)."""
    held, open_first = None, True
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part]).combine_chunks()
        g = held["g"].to_numpy()
        if not len(g):
            continue
        last = int(np.searchsorted(g, g[-1], side="left"))
        if last:
            yield held.slice(0, last), open_first, False
            held, open_first = held.slice(last), False
        while held.num_rows >= block_rows:
            yield held.slice(0, block_rows), True, True
            held, open_first = held.slice(block_rows), True
    if held is not None and held.num_rows:
        yield held, open_first, True


def _no_singles(block_rows: int):
    """Entries of columns that hold more than one class; one entry a class."""
    def run(batches):
        for table, open_first, open_last in _runs(batches, block_rows):
            g, hi = table["g"].to_numpy(), table["hi"].to_numpy()
            twice = np.zeros(len(g), dtype=bool)
            twice[1:] = (g[1:] == g[:-1]) & (hi[1:] == hi[:-1])
            at = np.flatnonzero(~twice)
            new = np.ones(len(at) + 1, dtype=bool)
            new[1:-1] = g[at][1:] != g[at][:-1]
            alone = new[:-1] & new[1:]
            if open_first:
                alone &= g[at] != g[0]
            if open_last:
                alone &= g[at] != g[-1]
            yield from table.take(pa.array(at[~alone])).combine_chunks().to_batches()

    return run


class _Rows:
    """Sorted entries as arrays, with the test of a pair in a column."""

    def __init__(self, table: pa.Table, percent: int):
        self.n, self.pos = (table[c].to_numpy().astype(np.int64) for c in ("n", "pos"))
        self.key = [table[c].to_numpy() for c in _KEY]
        self.root = [table[c].to_numpy() for c in ("chi", "clo")]
        bands = table["bands"].combine_chunks()
        raw = b"".join(bands.to_pylist())
        self.bands = np.frombuffer(raw, np.uint8).reshape(-1, BANDS)
        self.full = (self.bands == _FULL).any(axis=1)
        self.percent = percent

    def possible(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose overlap may suffice and whose components differ."""
        need = needed(self.n[i], self.n[j], self.percent)
        ok = (self.root[0][i] != self.root[0][j]) | (self.root[1][i] != self.root[1][j])
        ok &= np.minimum(self.n[i] - self.pos[i], self.n[j] - self.pos[j]) >= need
        i, j, need = i[ok], j[ok], need[ok]
        keep = np.zeros(len(i), dtype=bool)
        for a in range(0, len(i), 1 << 15):
            p, q = i[a:a + (1 << 15)], j[a:a + (1 << 15)]
            most = np.minimum(self.bands[p], self.bands[q]).sum(axis=1, dtype=np.int64)
            keep[a:a + (1 << 15)] = (most >= need[a:a + (1 << 15)]) | self.full[p] | self.full[q]
        return i[keep], j[keep]

    def batch(self, found: list[tuple[np.ndarray, np.ndarray]], extra: dict) -> pa.RecordBatch:
        """Distinct pairs as (ahi, alo, bhi, blo), the lesser key first."""
        i = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
        j = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.int64)
        hi, lo = self.key
        swap = (hi[i] > hi[j]) | ((hi[i] == hi[j]) & (lo[i] > lo[j]))
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        order = np.lexsort((lo[j], hi[j], lo[i], hi[i]))
        i, j = i[order], j[order]
        columns = [hi[i], lo[i], hi[j], lo[j]]
        new = np.ones(len(i), dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        pairs = [pa.array(c[new]) for c in columns]
        m = int(new.sum())
        return pa.RecordBatch.from_arrays([*pairs, *[pa.nulls(m, t) for t in extra.values()]], names=["ahi", "alo", "bhi", "blo", *extra])


_PAIR = "ahi bigint, alo bigint, bhi bigint, blo bigint"
_OPEN = {"g": pa.int64(), "block": pa.int64(), "pos": pa.int32(), "n": pa.int32(), "hi": pa.int64(), "lo": pa.int64(),
         "chi": pa.int64(), "clo": pa.int64(), "bands": pa.binary()}


def _starts(g: np.ndarray) -> np.ndarray:
    """First row of each row's column."""
    return np.searchsorted(g, g, side="left")


def _leaders(percent: int, block_rows: int):
    """In each block of a column: pairs of its first row with the others."""
    def run(batches):
        for table, _, _ in _runs(batches, block_rows):
            rows, first = _Rows(table, percent), _starts(table["g"].to_numpy())
            i = np.arange(len(first))
            first += (i - first) // block_rows * block_rows
            yield rows.batch([rows.possible(first[i != first], i[i != first])], {})

    return run


def _products(percent: int, block_rows: int):
    """All pairs of a block; rows of columns that may go on elsewhere, by block."""
    def run(batches):
        blocks = TaskContext.get().partitionId() << 33
        for table, open_first, open_last in _runs(batches, block_rows):
            g = table["g"].to_numpy()
            rows, first = _Rows(table, percent), _starts(g)
            at = np.arange(len(g))
            first += (at - first) // block_rows * block_rows
            end = np.searchsorted(first, first, side="right")
            whole = np.searchsorted(g, g, side="right") - np.searchsorted(g, g, side="left") <= block_rows
            found, i, shift = [], at, 1
            while len(i := i[i + shift < end[i]]):
                found.append(rows.possible(i, i + shift))
                shift += 1
            yield rows.batch(found, _OPEN)
            opened = ~whole | (open_first & (g == g[0])) | (open_last & (g == g[-1]))
            if opened.any():
                out = table.take(pa.array(np.flatnonzero(opened))).combine_chunks()
                block = pa.array(blocks + first[opened])
                none = [pa.nulls(out.num_rows, pa.int64())] * 4
                kept = [block if c == "block" else out[c].combine_chunks() for c in _OPEN]
                yield pa.RecordBatch.from_arrays([*none, *kept], names=["ahi", "alo", "bhi", "blo", *_OPEN])
            blocks += len(g)

    return run


def _across(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = _Rows(table, percent)
        side = table["side"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        step = max(1, (1 << 18) // max(len(right), 1))
        found = [rows.possible(np.repeat(part, len(right)), np.tile(right, len(part)))
                 for part in (left[a:a + step] for a in range(0, len(left), step))]
        return pa.Table.from_batches([rows.batch(found, {})])

    return run


# ---------------------------------------------------------------- the join

def _sorted(rows: DataFrame, order: list) -> DataFrame:
    return rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)


def _bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """The keys' low bits as a set of ``2^bits`` bits: at most ``2^bits / 64`` rows reach the driver."""
    place = F.col("lo").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(U64)


def _wanted_sets(wanted, k: int, bits: int):
    """Rows (hi, lo, grams) of the classes in the bit map, once a task."""
    def run(batches):
        seen = set()
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for _, _, part, bounds in chunks(data, offsets):
                h, first = shingle_sets(part, bounds, k)
                hi, lo = set_keys(h, first)
                place = lo.view(U64) & U64((1 << bits) - 1)
                hit = ((wanted.value[place >> U64(6)] >> (place & U64(63))) & U64(1)) == U64(1)
                at = []
                for i in np.flatnonzero(hit & (np.diff(first) > 0)).tolist():
                    key = (int(hi[i]), int(lo[i]))
                    if key not in seen:
                        seen.add(key)
                        at.append(i)
                if at:
                    grams = pa.array([h[first[i]:first[i + 1]].view(np.int64) for i in at], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(hi[at]), pa.array(lo[at]), grams], names=["hi", "lo", "grams"])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets link."""
    one = sets.select(F.col("hi").alias("ahi"), F.col("lo").alias("alo"), F.col("grams").alias("ga"))
    two = sets.select(F.col("hi").alias("bhi"), F.col("lo").alias("blo"), F.col("grams").alias("gb"))
    both = pairs.join(one, ["ahi", "alo"]).join(two, ["bhi", "blo"])
    shared = F.size(F.array_intersect("ga", "gb"))
    return both.where(shared * (100 + percent) >= percent * (F.size("ga") + F.size("gb"))).select("ahi", "alo", "bhi", "blo")


def class_links(texts: DataFrame, classes: DataFrame, counts: np.ndarray, k: int, percent: int, block_rows: int) -> DataFrame:
    """``(hi, lo, rhi, rlo)``: the root of every class that is linked with a lesser one."""
    spark = texts.sparkSession
    least = max(1, -(-percent // (100 - percent))) if percent < 100 else 1 << 30
    entries = shared_table(texts.mapInArrow(_entries(spark.sparkContext.broadcast(counts), k, percent, least), "g bigint, hi bigint, pos int"), "entries")
    common = shared_table(_sorted(entries, ["hi"]).mapInArrow(_no_singles(block_rows), entries.schema), "common")
    remove_table(entries)
    n_classes = max(classes.count(), 1)
    key = lambda hi, lo: F.struct(F.col(hi).alias("hi"), F.col(lo).alias("lo"))
    roots, seed = None, 0

    def rows() -> DataFrame:
        """The entries with their classes' sizes and components."""
        own = classes.select(*_KEY, F.col("n").cast("int").alias("n"), "bands")
        if roots is None:
            own = own.withColumns({"chi": F.col("hi"), "clo": F.col("lo")})
        else:
            own = own.join(roots, _KEY, "left").select(*own.columns, F.coalesce("rhi", "hi").alias("chi"), F.coalesce("rlo", "lo").alias("clo"))
        return common.join(own, "hi")

    def merged(found: DataFrame) -> tuple[DataFrame, int]:
        """The roots that all links found so far give, and how many links are new."""
        pairs = shared_table(found.dropDuplicates(), "pairs")
        keys = pairs.select(key("ahi", "alo").alias("c")).unionByName(pairs.select(key("bhi", "blo").alias("c"))).select("c.hi", "c.lo").distinct()
        wanted = spark.sparkContext.broadcast(_bit_map(keys, FILTER_BITS))
        sets = texts.mapInArrow(_wanted_sets(wanted, k, FILTER_BITS), "hi bigint, lo bigint, grams array<bigint>")
        sets = sets.groupBy(*_KEY).agg(F.first("grams").alias("grams"))  # one shuffle, used for both ends of the pairs
        new = shared_table(_linked(pairs, sets, percent), "links")
        remove_table(pairs)
        edges = new.select(key("ahi", "alo").alias("a"), key("bhi", "blo").alias("b"))
        if roots is not None:  # what is known already comes as stars
            edges = edges.unionByName(roots.select(key("hi", "lo").alias("a"), key("rhi", "rlo").alias("b")))
        found = connected_components(edges).select("node.hi", "node.lo", F.col("root.hi").alias("rhi"), F.col("root.lo").alias("rlo"))
        return found, new.count()

    while True:
        ordered = rows().withColumn("place", F.xxhash64("hi", "lo", F.lit(seed)))
        pairs = _sorted(ordered, ["place", *_KEY]).mapInArrow(_leaders(percent, block_rows), _PAIR)
        roots, new = merged(pairs)
        seed += 1
        if new * MANY_LINKS < n_classes:
            break
    open_schema = "g bigint, block bigint, pos int, n int, hi bigint, lo bigint, chi bigint, clo bigint, bands binary"
    found = shared_table(_sorted(rows(), _KEY).mapInArrow(_products(percent, block_rows), f"{_PAIR}, {open_schema}"), "products")
    remove_table(common)
    pairs = found.where("block IS NULL").select("ahi", "alo", "bhi", "blo")
    opened = found.where("block IS NOT NULL").select(*_OPEN)
    blocks = opened.groupBy("g", "block").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("chi", "clo") for f in (F.min, F.max)])
    x, y = blocks.alias("x"), blocks.alias("y")
    one_root = F.expr("least(x.min_chi, y.min_chi) = greatest(x.max_chi, y.max_chi) AND least(x.min_clo, y.min_clo) = greatest(x.max_clo, y.max_clo)")
    met = x.join(y, F.expr("x.g = y.g AND x.block < y.block")).where(~one_root).select("x.g", F.col("x.block").alias("one"), F.col("y.block").alias("two"))
    sides = [opened.join(met.withColumn("block", F.col(c)), ["g", "block"]).withColumn("side", F.lit(i)) for i, c in enumerate(("one", "two"))]
    across = sides[0].unionByName(sides[1]).groupBy("g", "one", "two").applyInArrow(_across(percent), _PAIR)
    return merged(pairs.unionByName(across))[0]


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90,
                       slots: int = SLOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(id, n, component)``, one row a document: the size of its shingle set
    and the smallest id it reaches by links."""
    texts = id_and_text(docs, id_col, text_col)
    described = shared_table(texts.mapInArrow(_describe(k, slots), "id bigint, hi bigint, lo bigint, n bigint, bands binary, part int, counts binary"), "described")
    rows = described.where("counts IS NULL").select("id", *_KEY, "n")
    classes = shared_table(described.where("n > 0").groupBy(*_KEY, "n", "bands").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "classes")
    roots = class_links(texts.select("text"), classes, _counts(described, slots), k, percent, block_rows)
    rooted = classes.join(roots, _KEY, "left").select(*_KEY, "least", "rows", F.coalesce("rhi", "hi").alias("rhi"), F.coalesce("rlo", "lo").alias("rlo"))
    labels = rooted.join(rooted.groupBy("rhi", "rlo").agg(F.min("least").alias("component")), ["rhi", "rlo"]).select(*_KEY, "rows", "component")
    labels = shared_table(labels, "labels")
    # classes that hold over a thousandth of all rows are under a thousand: those are broadcast
    total = labels.agg(F.sum("rows")).first()[0] or 0
    hot = labels.where(F.col("rows") * 1000 > total).select(*_KEY, F.col("component").alias("c"), F.lit(True).alias("is_hot"))
    own = rows.where("n = 0").select("id", "n", F.col("id").alias("component"))
    placed = rows.where("n > 0").join(F.broadcast(hot), _KEY, "left")
    done = placed.where("is_hot").select("id", "n", F.col("c").alias("component"))
    rest = placed.where("is_hot IS NULL").join(labels.select(*_KEY, "component"), _KEY).select("id", "n", "component")
    return done.unionByName(rest).unionByName(own)
