"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents hold a (short) benchmark item? The measure is containment:
the share of the item's distinct ``k``-word shingles that the document has.

1. Items are partitioned by size into classes ``[2^c, 2^(c+1))`` of distinct
   shingles. An item's sketch is its ``m`` smallest shingles by (number of
   items that have it, hash), ``m`` fixed by the class: one more than the
   shingles that an item of the class may miss at the threshold. Of ``m``
   shingles at least ``m - (n - ceil(t n)) >= 1`` must be in any document that
   reaches the threshold, whatever the order, so the search misses nothing;
   phrases that many items share come last, so they are in few sketches.
2. Documents stream through once. A document's shingle hashes are tested
   against two fixed-size bit maps (``2^bits`` bits each, whatever the number
   of items): of the sketches, and of all item shingles. Only documents with
   a sketch hit emit rows: their distinct shingles that may belong to items.
3. Those rows join the sketches alone, on the shingle itself. Only pairs with
   enough sketch hits meet the items' other shingles, and are verified by
   exact shingle containment.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text of fewer than
``k`` words has its whole word sequence as its only shingle; such an item is
found in documents that are that sequence. Texts without words (null, empty)
hold and match nothing. Null ids are ids like others. Rows that repeat an id
count as one document. Extra columns are ignored. Either table may be empty.
A long text streams through whole; a row is kept of each of its shingles that
may belong to an item.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import id_and_text, shared_table
from flowlens.llm.textarrays import U64, Words, chunks, text_buffers

BITMAP_BITS = 23


def shingle_rows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: (hash, text number, first word, words) of its shingles, the
    whole sequence where it is shorter."""
    hashes = words.hashes()
    h, at = words.shingles(k, hashes)
    parts = [(h, words.text[at], at, np.full(len(at), k))]
    count = np.diff(words.first)
    for n in range(1, k):
        texts = np.flatnonzero(count == n)
        if len(texts):
            own, at = words.shingles(n, hashes)
            pick = np.isin(at, words.first[texts])
            parts.append((own[pick] + U64(n), words.text[at[pick]], at[pick], np.full(int(pick.sum()), n)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def sketch_length(n: int, threshold: float) -> int:
    """Sketch values of an item of ``n`` shingles: fixed by its size class."""
    top = 2 ** (n.bit_length()) - 1
    return min(n, allowed_misses(top, threshold) + 1)


def allowed_misses(n: int, threshold: float) -> int:
    return n - math.ceil(threshold * n - 1e-9)


def _item_rows(k: int, threshold: float):
    names = ["item", "version", "n", "m", "need", "h", "shingle"]

    def run(batches):
        for batch in batches:
            rows = []
            data, offsets = text_buffers(batch.column(1))
            for first, _, part, bounds in chunks(data, offsets):
                words = Words(part, bounds)
                h, text, at, size = shingle_rows(words, k)
                for i in range(len(bounds) - 1):
                    own = {int(h[j]): words.words_text(at[j], size[j]) for j in np.flatnonzero(text == i)}
                    n = len(own)
                    if n:
                        m = sketch_length(n, threshold)
                        version = int(np.bitwise_xor.reduce(np.array(list(own), U64)).astype(np.int64))
                        rows += [(batch.column(0)[first + i].as_py(), version, n, m, m - allowed_misses(n, threshold),
                                  int(np.uint64(x).astype(np.int64)), own[x]) for x in own]
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=pa.schema([
                ("item", pa.int64()), ("version", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("need", pa.int64()),
                ("h", pa.int64()), ("shingle", pa.string())]))

    return run


def item_sketches(items: DataFrame, k: int, threshold: float) -> DataFrame:
    """Every shingle of every item, and whether it is in the item's sketch."""
    rows = shared_table(items.mapInArrow(_item_rows(k, threshold), "item bigint, version bigint, n bigint, m bigint, need bigint, h bigint, shingle string")
                        .dropDuplicates(), "item_shingles")
    shared_by = rows.groupBy("h", "shingle").agg(F.count(F.lit(1)).alias("items"))
    # an item is one row of a bounded text: its shingles are ranked in one task
    place = F.row_number().over(Window.partitionBy("item", "version").orderBy("items", F.xxhash64("h"), "h", "shingle"))
    ranked = rows.join(shared_by, ["h", "shingle"]).withColumn("in_sketch", place <= F.col("m"))
    return shared_table(ranked.select("item", "version", "n", "need", "h", "shingle", "in_sketch"), "items")


def _bit_map(hashes: DataFrame, bits: int) -> np.ndarray:
    """The set of hashes as ``2^bits`` bits: at most ``2^bits / 64`` rows reach the driver."""
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    words = (hashes.select(F.shiftright(place, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(U64)


def _hits(sketches, shingles, k: int, bits: int):
    def known(bit_map, h):
        at = h & U64((1 << bits) - 1)
        return (bit_map[at >> U64(6)] >> (at & U64(63))) & U64(1) == U64(1)

    def run(batches):
        sketch_map, shingle_map = sketches.value, shingles.value
        for batch in batches:
            ids, hs, texts = [], [], []
            data, offsets = text_buffers(batch.column(1))
            for first, _, part, bounds in chunks(data, offsets):
                words = Words(part, bounds)
                h, text, at, size = shingle_rows(words, k)
                hot = np.zeros(len(bounds) - 1, dtype=bool)
                hot[text[known(sketch_map, h)]] = True
                pick = np.flatnonzero(hot[text])
                pick = pick[known(shingle_map, h[pick])]
                seen = set()
                for j in pick.tolist():
                    key = (int(text[j]), int(h[j]))
                    if key not in seen:
                        seen.add(key)
                        ids.append(batch.column(0)[first + key[0]].as_py())
                        hs.append(h[j].astype(np.int64))
                        texts.append(words.words_text(at[j], size[j]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hs, pa.int64()), pa.array(texts, pa.string())],
                                             names=["id", "h", "shingle"])

    return run


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text", k: int = 5,
                    threshold: float = 0.8, bits: int = BITMAP_BITS) -> DataFrame:
    """Pairs (``id``, ``item``) whose containment reaches the threshold, with
    ``n_shared``, ``n_item`` (distinct shingles) and ``containment``. Where
    several rows carry one item id, the largest containment counts."""
    spark = docs.sparkSession
    rows = item_sketches(id_and_text(items, item_id_col, item_text_col), k, threshold)
    sketches = spark.sparkContext.broadcast(_bit_map(rows.where("in_sketch"), bits))
    shingles = spark.sparkContext.broadcast(_bit_map(rows, bits))
    hits = id_and_text(docs, id_col, text_col).mapInArrow(_hits(sketches, shingles, k, bits), "id bigint, h bigint, shingle string").dropDuplicates()
    # a null id is an id; joins take its place and a flag instead
    hits = shared_table(hits.select(F.coalesce("id", F.lit(0)).alias("doc"), F.col("id").isNull().alias("no_id"), "h", "shingle"), "hits")
    rows = rows.select(F.coalesce("item", F.lit(0)).alias("own"), F.col("item").isNull().alias("no_item"), "version", "n", "need", "h", "shingle", "in_sketch")
    pair = ["doc", "no_id", "own", "no_item", "version"]
    near = (hits.join(rows.where("in_sketch"), ["h", "shingle"]).groupBy(*pair, "n", "need").agg(F.count(F.lit(1)).alias("n_sketch"))
            .where(F.col("n_sketch") >= F.col("need")).select(*pair))
    wanted = near.join(rows.drop("need", "in_sketch"), ["own", "no_item", "version"])
    pairs = (wanted.join(hits, ["doc", "no_id", "h", "shingle"]).groupBy(*pair, "n").agg(F.count(F.lit(1)).alias("n_shared"))
             .withColumn("containment", F.col("n_shared") / F.col("n"))
             .where(F.col("containment") >= threshold)
             .withColumns({"id": F.when(~F.col("no_id"), F.col("doc")), "item": F.when(~F.col("no_item"), F.col("own"))}))
    best = F.max(F.struct("containment", "n_shared", F.col("n").alias("n_item"))).alias("best")
    return pairs.groupBy("id", "item").agg(best).select("id", "item", "best.n_shared", "best.n_item", "best.containment")
