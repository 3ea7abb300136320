"""Line deduplication over a sharded minimal perfect hash.

A line's key is the line without white space at both ends and with A-Z
lower-cased. Keys of at least ``min_chars`` code points that stand in at
least ``min_docs`` documents lose all their lines except in the largest id
that holds them.

1. Each document gives its distinct keys as 128-bit hashes; counting them by
   hash pre-aggregates before the shuffle, so a line that a third of all
   documents share costs one partial row a task.
2. The frequent hashes are dealt to shards of at most about ``shard_keys``
   keys and ``cell_rows`` probes. A shard becomes one row: a minimal perfect hash (levels of bit arrays; a key
   belongs to the first level where its bit is set, its index is the rank of
   that bit) that indexes arrays of fingerprints, document counts and keepers.
3. Documents probe the arrays: their line hashes meet the shard's arrays,
   not its lines. A shard with many probes is cut into cells by document, so
   a hot line spreads over as many tasks as its rows need.
4. What was found is gathered by document, whose text is then rewritten.

Nulls: a null text is one empty line; rows with a null id count as one
document whose id is below every other. Rows that repeat an id count as one
document and are all rewritten alike. An empty table gives an empty table.
Extra columns are kept; one named like an added column is replaced by it. A long text is split whole; its lines' hashes, 8 bytes
each, are dealt on their own, and it is rewritten in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import BLANKS, id_and_text, schema_with, shared_table
from flowlens.llm.textarrays import U64, mix

SHARD_KEYS = 50_000
CELL_ROWS = 200_000


def line_key(line: str, min_chars: int) -> bytes | None:
    """The 128-bit hash of a line's key; None where the key is too short to count."""
    key = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(key.encode("utf-8", "replace").lower()) if len(key) >= min_chars else None


# ---------------------------------------------------------------- minimal perfect hash

def _bit(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = U64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix(mix(h1 ^ seed) + h2) % U64(size)).astype(np.int64)


def _halves(keys: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(keys, dtype="<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def build_mph(h1: np.ndarray, h2: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Level sizes (in bits, multiples of 64) and the levels' words, for distinct keys."""
    sizes, words, level = [], [], 0
    while len(h1):
        size = -(-2 * len(h1) // 64) * 64
        at = _bit(h1, h2, level, size)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = ~alone[at]
        h1, h2, level = h1[left], h2[left], level + 1
    return sizes, np.concatenate(words) if words else np.zeros(0, "<u8")


def mph_index(sizes: list[int], words: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Each key's place among the keys built from; -1 or any place for other keys."""
    ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    out = np.full(len(h1), -1, dtype=np.int64)
    todo, base = np.arange(len(h1)), 0
    for level, size in enumerate(sizes):
        at = _bit(h1[todo], h2[todo], level, size)
        word, bit = base + (at >> 6), (at & 63).astype(U64)
        value = words[word]
        found = (value >> bit) & U64(1) == U64(1)
        below = value[found] & ((U64(1) << bit[found]) - U64(1))
        out[todo[found]] = ranks[word[found]] + np.bitwise_count(below)
        todo, base = todo[~found], base + size // 64
    return out


def _shard_row(table: pa.Table) -> pa.Table:
    """One shard's frequent keys as one row of arrays."""
    h1, h2 = _halves(b"".join(table["k"].to_pylist()))
    sizes, words = build_mph(h1, h2)
    at = mph_index(sizes, words, h1, h2)
    arrays = {"fingerprints": h1 ^ mix(h2), "counts": table["n"].to_numpy(), "keepers": table["keeper"].to_numpy()}
    placed = {}
    for name, values in arrays.items():
        placed[name] = np.empty_like(values)
        placed[name][at] = values
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
        "bits": pa.array([words.tobytes()], pa.binary()),
        **{n: pa.array([v.tobytes()], pa.binary()) for n, v in placed.items()},
    })


_SHARD_SCHEMA = "shard bigint, sizes array<bigint>, bits binary, fingerprints binary, counts binary, keepers binary"


def _probe(lines: pa.Table, shard: pa.Table) -> pa.Table:
    """The (id, key) rows of one cell whose line is frequent and kept elsewhere."""
    if lines.num_rows and shard.num_rows:
        row = {n: shard[n][0].as_py() for n in ("sizes", "bits", "fingerprints", "keepers")}
        fingerprints, keepers = np.frombuffer(row["fingerprints"], "<u8"), np.frombuffer(row["keepers"], "<i8")
        h1, h2 = _halves(b"".join(lines["k"].to_pylist()))
        at = mph_index(row["sizes"], np.frombuffer(row["bits"], "<u8"), h1, h2)
        known = at >= 0
        known[known] = fingerprints[at[known]] == (h1 ^ mix(h2))[known]
        ids = lines["id"].combine_chunks() if isinstance(lines["id"], pa.ChunkedArray) else lines["id"]
        own = ids.fill_null(0).to_numpy(zero_copy_only=False)
        elsewhere = known.copy()
        elsewhere[known] = (own[known] != keepers[at[known]]) | ids.is_null().to_numpy(zero_copy_only=False)[known]
        lines = lines.filter(pa.array(elsewhere))
    else:
        lines = lines.slice(0, 0)
    return lines.select(["id", "k"])


# ---------------------------------------------------------------- the operator

def _keys(min_chars: int):
    def run(batches):
        for batch in batches:
            ids, keys = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(text) < min_chars:
                    continue
                own = {k for k in (line_key(x, min_chars) for x in text.split("\n") if len(x) >= min_chars) if k}
                ids += [i] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["k", "id"])

    return run


def _rewrite(names: list[str], text_col: str, min_chars: int):
    """Appends n_lines, n_dropped and puts the kept lines in the text column."""
    def run(batches):
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(text_col).to_pylist(), batch.column("__drop").to_pylist()):
                text = text or ""
                n = text.count("\n") + 1
                if drop:
                    drop = set(drop)
                    lines = [x for x in text.split("\n") if line_key(x, min_chars) not in drop]
                    text = "\n".join(lines)
                n_lines.append(n)
                n_dropped.append(n - len(lines) if drop else 0)
                kept.append(text)
            new = {text_col: pa.array(kept, pa.string()), "n_lines": pa.array(n_lines, pa.int64()),
                   "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)

    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
               min_docs: int = 5, shard_keys: int = SHARD_KEYS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``docs`` with the kept lines in ``text_col``, plus ``n_lines`` (before
    dropping) and ``n_dropped``."""
    keys = shared_table(id_and_text(docs, id_col, text_col).mapInArrow(_keys(min_chars), "k binary, id bigint"), "line_keys")
    frequent = shared_table(
        keys.dropDuplicates(["k", "id"]).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs), "frequent")
    shards = max(1, -(-frequent.count() // shard_keys), -(-keys.count() // cell_rows))
    shard = F.pmod(F.xxhash64("k"), F.lit(shards)).alias("shard")
    arrays = frequent.select("*", shard).groupBy("shard").applyInArrow(_shard_row, _SHARD_SCHEMA)
    probes = keys.select("*", shard)
    cells = probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / cell_rows).cast("bigint").alias("cells"))
    probes = probes.join(cells, "shard").select(
        "shard", F.pmod(F.xxhash64(F.coalesce("id", F.lit(-1)), F.lit(1)), F.col("cells")).alias("cell"), "id", "k")
    arrays = arrays.join(cells, "shard").withColumn("cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cells") - 1)))
    drop = (probes.groupBy("shard", "cell").cogroup(arrays.groupBy("shard", "cell"))
            .applyInArrow(_probe, "id bigint, k binary")
            .groupBy(F.col("id").alias("__id")).agg(F.collect_set("k").alias("__drop")))
    out = schema_with(docs, [("n_lines", "bigint"), ("n_dropped", "bigint")], text_col)
    return (docs.select(*[F.col(f"`{f.name}`") for f in docs.schema if f.name in out.names])
            .join(drop, F.col(id_col).cast("bigint").eqNullSafe(F.col("__id")), "left")
            .mapInArrow(_rewrite(out.names, text_col, min_chars), out))
