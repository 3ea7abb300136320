"""Exact substring deduplication by suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts
earlier: in a document with a smaller id, or earlier in the same one. Strings
never cross documents and are judged on the input.

1. Anchors. Every window of ``length`` bytes names one anchor, the rightmost
   smallest hash among its ``GRAM``-byte grams, so equal windows have equal
   anchors at equal places. A window can only repeat if its anchor's hash
   does; hashes are counted over all shards, pre-aggregated by shard.
2. Documents are dealt to shards of about ``shard_bytes`` by a hash of the
   id. A shard puts the stretches with repeated anchors into one text, sorts
   its suffixes by Larsson-Sadakane refinement (rank by 8 bytes, then refine
   only the groups that are still tied by the rank further on, doubling the
   distance), and takes common prefixes by Kasai's rule (a suffix shares at
   least one byte less than the one before it in the text). Neighbours that
   share ``length`` bytes are one string; all but its first place go.
3. First places whose anchor is known to other shards meet those by the
   anchor's hash: each shard's windows are a sorted run, and runs are merged
   pairwise by binary search; of equal windows the least place stays. A
   string that a third of all documents share sends one window a shard.
4. The covered stretches go back to the shards, which rewrite the documents.

Nulls: a null text is empty; a null id is below every other. Rows that repeat
an id are documents of their own, ordered by text. An empty table gives an
empty table. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import shared_table
from flowlens.llm.textarrays import U64, mix, powers, text_buffers

LENGTH = 100
GRAM = 32
SHARD_BYTES = 4 << 20
BUCKET_ROWS = 4_000
#: Bytes whose anchors are found at once; a place in them fits the low bits of a key.
PIECE = 1 << 20
_PLACE = U64((1 << 21) - 1)


# ---------------------------------------------------------------- anchors

def pieces(data: np.ndarray, offsets: np.ndarray, length: int):
    """Stretches of at most ``PIECE`` bytes: (bytes, bounds, documents, offsets in
    them). A longer document is cut with an overlap of ``length - 1`` bytes."""
    spans = []
    for doc in np.flatnonzero(np.diff(offsets) >= length).tolist():
        a, b = int(offsets[doc]), int(offsets[doc + 1])
        step = PIECE - length + 1
        spans += [(x, min(x + PIECE, b), doc, x - a) for x in range(a, max(b - length + 1, a + 1), step)]
    first = 0
    while first < len(spans):
        end, size = first, 0
        while end < len(spans) and (end == first or size + spans[end][1] - spans[end][0] <= PIECE):
            size += spans[end][1] - spans[end][0]
            end += 1
        own = spans[first:end]
        yield (np.concatenate([data[x:y] for x, y, _, _ in own]), np.cumsum([0] + [y - x for x, y, _, _ in own]),
               np.array([d for _, _, d, _ in own]), np.array([o for _, _, _, o in own]))
        first = end


def anchor_runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one anchor: (anchor hash, first window,
    last window, stretch). Windows lie within one stretch."""
    n = len(data)
    up, down = powers(n)
    run = np.zeros(n + 1, dtype=U64)
    np.cumsum((data.astype(U64) + U64(1)) * up, dtype=U64, out=run[1:])
    h = mix((run[gram:] - run[:-gram]) * down[:n - gram + 1])
    least = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=U64))
    span, wanted = 1, length - gram + 1
    while span < wanted:
        step = min(span, wanted - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    piece = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    window = np.flatnonzero(piece[:n - length + 1] == piece[length - 1:])
    anchor = (_PLACE - (least[window] & _PLACE)).astype(np.int64)
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(window)) - 1
    return h[anchor[at]], window[at], window[last], piece[window[at]]


def _anchor_rows(length: int, gram: int):
    """Distinct (anchor hash, shard) of each batch with their number of runs."""
    def run(batches):
        for batch in batches:
            shard = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            hashes, shards = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
            for part, bounds, docs, _ in pieces(data, offsets, length):
                h, _, _, piece = anchor_runs(part, bounds, length, gram)
                hashes.append(h)
                shards.append(shard[docs[piece]])
            h, s = np.concatenate(hashes), np.concatenate(shards)
            order = np.lexsort((s, h))
            h, s = h[order], s[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(h)))
            yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(s[at]), pa.array(count)], names=["h", "shard", "n"])

    return run


def _repeated(batches):
    """Of rows sorted by (h, shard): (shard, h, crosses) for hashes met twice;
    ``crosses``: also met in another shard. The last hash of a batch waits for the next."""
    held = None

    def of(h, shard, n):
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[1:] != h[:-1]
        at = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        total = np.add.reduceat(n, at)[group]
        crosses = (np.minimum.reduceat(shard, at) != np.maximum.reduceat(shard, at))[group]
        pair = new.copy()
        pair[1:] |= shard[1:] != shard[:-1]
        keep = (total > 1) & pair
        return pa.RecordBatch.from_arrays([pa.array(shard[keep]), pa.array(h[keep]), pa.array(crosses[keep])], names=["shard", "h", "crosses"])

    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if cut:
            yield of(*(x[:cut] for x in now))
        held = [x[cut:] for x in now]
    if held is not None:
        yield of(*held)


# ---------------------------------------------------------------- suffix arrays

def first_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place, as a big-endian number."""
    out = np.zeros(len(text), dtype=U64)
    for i in range(8):
        out[:len(text) - i] |= text[i:].astype(U64) << U64(56 - 8 * i)
    return out


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The places of ``text`` in the order of their suffixes."""
    n = len(text)
    sa = np.argsort(words, kind="stable")
    head = np.ones(n, dtype=bool)
    head[1:] = words[sa[1:]] != words[sa[:-1]]
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.zeros(n + 1, dtype=np.int64)
    rank[sa] = start + 1
    step = 8
    while True:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            break
        place = sa[tied]
        key = start[tied] * (n + 2) + rank[np.minimum(place + step, n)]
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        sa[tied] = place
        new = np.ones(len(tied), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        head[tied] = new
        start[tied] = np.maximum.accumulate(np.where(new, tied, 0))
        rank[place] = start[tied] + 1
        step *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, words: np.ndarray, cap: int, stride: int = 8) -> np.ndarray:
    """Bytes (up to ``cap``) that each suffix shares with the one before it in
    ``sa``. Kasai's rule, with every ``stride``-th place of the text at once."""
    n = len(sa)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.append(words, U64(0))
    shared = np.zeros(n, dtype=np.int64)
    for phase in range(min(stride, n)):
        at = np.arange(phase, n, stride)
        size = np.maximum(shared[at - 1] - 1, 0) if phase else np.zeros(len(at), dtype=np.int64)
        live = np.flatnonzero(before[at] >= 0)
        size[before[at] < 0] = 0
        while len(live):
            i, j = at[live] + size[live], before[at[live]] + size[live]
            differ = words[np.minimum(i, n)] ^ words[np.minimum(j, n)]
            same = np.zeros(len(live), dtype=np.int64)
            for byte in range(8):
                same += differ < (U64(1) << U64(8 * byte))
            same = np.minimum(same, n - np.maximum(i, j))
            size[live] = np.minimum(size[live] + same, cap)
            live = live[(same == 8) & (size[live] < cap)]
        shared[at] = size
    return shared[sa]


def repeats_in(text: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """For each window (a place in ``text``): whether an earlier window is equal."""
    words = first_bytes(text)
    sa = suffix_array(text, words)
    group = np.cumsum(common_prefixes(text, sa, words, length) < length)
    is_window = np.zeros(len(text), dtype=bool)
    is_window[windows] = True
    own = is_window[sa]
    place, group = sa[own], group[own]
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    first = np.repeat(np.minimum.reduceat(place, at), np.diff(np.append(at, len(place))))
    again = np.zeros(len(text), dtype=bool)
    again[place] = place != first
    return again[windows]


# ---------------------------------------------------------------- one shard

def _sorted(table: pa.Table, *columns: str) -> pa.Table:
    return table.take(pc.sort_indices(table, [(c, "ascending") for c in columns], null_placement="at_start"))


def _ordered(table: pa.Table) -> pa.Table:
    """A shard's documents by id (nulls first), then by text: their order and numbers."""
    return _sorted(table, "id", "text")


def _stretches(doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (sorted by document and start) as covered stretches: document, start, end."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], start[last[:len(at)]] + length


_FOUND = "shard bigint, doc bigint, id bigint, start bigint, stop bigint, h bigint, bytes binary"


def _found(shard, doc, ids, start, stop, h=None, text=None) -> pa.Table:
    n = len(doc)
    return pa.table({"shard": pa.array(np.full(n, shard)), "doc": pa.array(doc, pa.int64()), "id": ids.take(pa.array(doc, pa.int64())) if n else pa.array([], pa.int64()),
                     "start": pa.array(start, pa.int64()), "stop": pa.array(stop, pa.int64()),
                     "h": pa.nulls(n, pa.int64()) if h is None else pa.array(h.view(np.int64)),
                     "bytes": pa.nulls(n, pa.binary()) if text is None else pa.array(text, pa.binary())})


def _search_shard(length: int, gram: int):
    """Covered stretches of the shard (no bytes), and its first windows whose
    anchor other shards know (with bytes; ``start`` is the first window's)."""
    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        ids = pa.array([], pa.int64())
        if not docs.num_rows or not known.num_rows:
            return _found(0, np.zeros(0, np.int64), ids, [], [])
        docs = _ordered(docs)
        shard, ids = docs["shard"][0].as_py(), docs["id"].combine_chunks()
        known = known.sort_by("h")
        hashes, crosses = known["h"].to_numpy(), known["crosses"].to_numpy(zero_copy_only=False)
        data, offsets = text_buffers(docs["text"])
        runs = []
        for part, bounds, number, shift in pieces(data, offsets, length):
            h, first, last, piece = anchor_runs(part, bounds, length, gram)
            at = np.minimum(np.searchsorted(hashes, h.view(np.int64)), len(hashes) - 1)
            keep = hashes[at] == h.view(np.int64)
            place = offsets[number] + shift - bounds[:-1]
            runs.append((h[keep], first[keep] + place[piece[keep]], last[keep] + place[piece[keep]], number[piece[keep]], crosses[at[keep]]))
        if not runs or not sum(len(r[0]) for r in runs):
            return _found(shard, np.zeros(0, np.int64), ids, [], [])
        h, first, last, doc, cross = (np.concatenate(x) for x in zip(*runs))
        count = last - first + 1
        run_of = np.repeat(np.arange(len(h)), count)
        window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[run_of]
        new = np.append(True, (doc[1:] != doc[:-1]) | (first[1:] != last[:-1] + 1))
        at = np.flatnonzero(new)
        begin, stop = first[at], np.append(last[at[1:] - 1], last[-1]) + length
        text = np.concatenate([data[a:b] for a, b in zip(begin.tolist(), stop.tolist())])
        place = np.cumsum(stop - begin) - (stop - begin)
        again = repeats_in(text, window - np.repeat((begin - place)[np.cumsum(new) - 1], count), length)
        start = window - offsets[doc[run_of]]
        out = [_found(shard, *_with_ids(_stretches(doc[run_of[again]], start[again], length), ids))]
        asked = np.flatnonzero(~again & cross[run_of])
        if len(asked):
            new = np.append(True, (run_of[asked[1:]] != run_of[asked[:-1]]) | (asked[1:] != asked[:-1] + 1))
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(asked)) - 1
            a, b = window[asked[at]], window[asked[end]] + length
            owner = run_of[asked[at]]
            out.append(_found(shard, doc[owner], ids, start[asked[at]], start[asked[end]] + length, h[owner],
                              [data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist())]))
        return pa.concat_tables(out)

    return run


def _with_ids(stretches, ids):
    doc, start, stop = stretches
    return doc, ids, start, stop


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sorted runs of (strings, places), each without equal strings: the places
    that a smaller place's string equals. Runs are merged pairwise by binary search."""
    lost = [np.zeros(0, np.int64)]
    while len(runs) > 1:
        merged = []
        for (a, x), (b, y) in zip(runs[::2], runs[1::2]):
            at = np.searchsorted(a, b)
            met = at < len(a)
            met[met] = a[at[met]] == b[met]
            lost.append(np.maximum(x[at[met]], y[met]))
            x = x.copy()
            x[at[met]] = np.minimum(x[at[met]], y[met])
            merged.append((np.insert(a, at[~met], b[~met]), np.insert(x, at[~met], y[~met])))
        runs = merged + runs[len(merged) * 2:]
    return np.concatenate(lost)


def _equal_rows(blobs: list[bytes], h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows by place: which equal an earlier row whole, and which of the
    rest share their anchor's hash with another of the rest."""
    first: dict[bytes, int] = {}
    again = np.fromiter((first.setdefault(b, i) != i for i, b in enumerate(blobs)), bool, len(blobs))
    rest = np.flatnonzero(~again)
    _, group, size = np.unique(h[rest], return_inverse=True, return_counts=True)
    return np.flatnonzero(again), rest[size[group] > 1]


def _merge_bucket(length: int):
    """Windows that another shard holds at a smaller place, as covered stretches.

    A row that equals an earlier one whole is lost whole; only different rows
    with one anchor are compared window by window."""
    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table, "id", "shard", "doc", "start")
        shard, doc, start, h = (table[c].to_numpy() for c in ("shard", "doc", "start", "h"))
        blobs = table["bytes"].to_pylist()
        whole, rest = _equal_rows(blobs, h)
        size = np.array([len(b) for b in blobs])
        parts = [pa.table({"shard": pa.array(shard[whole]), "doc": pa.array(doc[whole]), "start": pa.array(start[whole]),
                           "stop": pa.array(start[whole] + size[whole])})]
        blobs, shard, doc, start, size = [blobs[i] for i in rest], shard[rest], doc[rest], start[rest], size[rest]
        if not blobs:
            return parts[0]
        count = size - length + 1
        row = np.repeat(np.arange(len(blobs)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        # UTF-8 holds no byte 255, so adding one keeps the order and leaves no zero, which ends numpy's strings
        text = np.frombuffer(b"".join(blobs), np.uint8) + np.uint8(1)
        place = (np.cumsum(size) - size)[row] + offset
        strings = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, length)[place]).view(f"S{length}").ravel()
        runs = []
        for s in np.unique(shard):
            own = np.flatnonzero(shard[row] == s)
            order = own[np.argsort(strings[own], kind="stable")]
            runs.append((strings[order], order))
        lost = np.unique(merge_runs(runs))
        owner = row[lost]
        order = np.lexsort((start[owner] + offset[lost], doc[owner], shard[owner]))
        owner, at = owner[order], (start[owner] + offset[lost])[order]
        for s in np.unique(shard[owner]):
            own = shard[owner] == s
            d, a, b = _stretches(doc[owner[own]], at[own], length)
            parts.append(pa.table({"shard": pa.array(np.full(len(d), s)), "doc": pa.array(d), "start": pa.array(a), "stop": pa.array(b)}))
        return pa.concat_tables(parts)

    return run


def _rewrite_shard(docs: pa.Table, covered: pa.Table) -> pa.Table:
    """Each document's bytes that no stretch covers."""
    docs = _ordered(docs)
    data, offsets = text_buffers(docs["text"]) if docs.num_rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    steps = np.zeros(len(data) + 1, dtype=np.int32)
    if covered.num_rows:
        place = offsets[covered["doc"].to_numpy()]
        np.add.at(steps, place + covered["start"].to_numpy(), 1)
        np.add.at(steps, place + covered["stop"].to_numpy(), -1)
    gone = np.cumsum(steps[:-1]) > 0
    kept, removed, spans = [], [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        own = gone[a:b]
        removed.append(int(own.sum()))
        spans.append(int(np.count_nonzero(own[1:] & ~own[:-1])) + int(own[:1].sum()) if removed[-1] else 0)
        kept.append((data[a:b][~own] if removed[-1] else data[a:b]).tobytes())
    return pa.table({"id": docs["id"], "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary())})


# ---------------------------------------------------------------- the operator

def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row a document: ``id``, ``n_bytes``, ``n_removed``, ``n_spans`` (runs
    of removed bytes) and ``kept`` (the other bytes)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    rows = rows.select(F.pmod(F.xxhash64(F.coalesce("id", F.lit(-1))), F.lit(max(1, -(-total // shard_bytes)))).alias("shard"), "id", "text")
    anchors = rows.select("shard", "text").mapInArrow(_anchor_rows(length, gram), "h bigint, shard bigint, n bigint")
    known = shared_table(anchors.repartition("h").sortWithinPartitions("h", "shard").mapInArrow(_repeated, "shard bigint, h bigint, crosses boolean"), "anchors")
    found = shared_table(rows.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(_search_shard(length, gram), _FOUND), "found")
    asked = found.where("h IS NOT NULL")
    buckets = max(1, -(-asked.count() // BUCKET_ROWS))
    lost = (asked.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets))).groupBy("bucket")
            .applyInArrow(_merge_bucket(length), "shard bigint, doc bigint, start bigint, stop bigint"))
    covered = found.where("h IS NULL").select("shard", "doc", "start", "stop").unionByName(lost)
    return rows.groupBy("shard").cogroup(covered.groupBy("shard")).applyInArrow(
        _rewrite_shard, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
