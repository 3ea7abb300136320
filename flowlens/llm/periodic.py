"""Periodic runs of words, by string synchronising sets.

A run is a maximal stretch of words with smallest period ``q`` (words ``q``
apart are equal) of at least ``4 q`` words. Words are ``[^\\x20\\x09-\\x0D]+``,
compared as they are.

Periods in ``[t, 2t)`` are found at scale ``t``, a power of two:

1. Every position has an identifier, a hash of the ``t`` words from there;
   identifiers double from scale to scale. A position is selected if the least
   identifier of the ``t + 1`` positions from it on is its own or that of the
   position ``t`` later. The choice depends on the next ``2t`` words alone, so
   equal contexts of ``2t`` words are selected alike wherever they stand.
2. Positions whose ``t`` words have a period of at most ``t / 4`` take no part
   in the minimum: in such regions identifiers repeat, and all would be
   selected. These regions are the runs of smaller periods, found at smaller
   scales; they supply the periods that this scale omits. Elsewhere each
   stretch of ``t`` positions holds a selected one.
3. Next to each other among selected positions with equal context, two
   positions whose distance is in ``[t, 2t)`` propose it as a period. A run of
   period ``q`` in ``[t, 2t)`` has a selected position among its first ``t``,
   and its copy ``q`` later lies in the run with its whole context: no run of
   four periods is missed. A nearer copy would make the period smaller, so the
   proposed period is the smallest.
4. Each proposal is extended word by word in both directions; hashes only
   propose.

Texts are worked on in chunks of whole texts, one longer text alone; its
memory is a small multiple of the text. Null and empty texts have no words and
no runs. Rows are worked on each for itself: null or repeated ids, ties and
repeated rows need no rule. An empty table gives an empty table. Of the other
columns none is read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.textarrays import U64, mix

PERIODS = 4
CHUNK_WORDS = 1 << 16
_MOST = U64(0xFFFFFFFFFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, by prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, _MOST, dtype=U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def selected(ids: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """The positions of the synchronising set of scale ``t``."""
    if len(ids) <= t:
        return np.zeros(0, np.int64)
    own = np.where(periodic, _MOST, ids)
    least = sliding_min(own, t + 1)
    return np.flatnonzero((least != _MOST) & ((least == own[:-t]) | (least == own[t:])))


def proposals(contexts: np.ndarray, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, position), in order, of neighbours with equal context at a distance in ``[t, 2t)``."""
    order = np.argsort(contexts[at], kind="stable")
    at = at[order]
    found = contexts[at]
    far = at[1:] - at[:-1]
    pick = np.flatnonzero((found[1:] == found[:-1]) & (far >= t) & (far < 2 * t))
    period, place = far[pick], at[pick]
    order = np.lexsort((place, period))
    return period[order], place[order]


def _agree(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many positions from ``at`` on, in direction ``step``, equal the one ``period`` later."""
    done, size = 0, 64
    room = len(words) - period - at if step > 0 else at + 1
    while done < room:
        size = min(size, room - done)
        a = at + done if step > 0 else at - done - size + 1
        same = words[a:a + size] == words[a + period:a + period + size]
        if not same.all():
            return done + int(np.argmin(same if step > 0 else same[::-1]))
        done, size = done + size, size * 2
    return done


def find_runs(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of the runs of texts whose word
    numbers are ``words[first[i]:first[i + 1]]``, in that order."""
    sizes = np.diff(first)
    runs: list[tuple[int, int, int, int]] = []
    texts = np.flatnonzero(sizes >= PERIODS)
    if not len(texts):
        return np.zeros((0, 4), np.int64)
    # one word of its own after each text: no run crosses texts
    numbers = np.empty(int(first[-1]) + len(sizes), dtype=np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    last = first[1:] + np.arange(len(sizes))
    inner = np.ones(len(numbers), dtype=bool)
    inner[last] = False
    numbers[inner] = words
    numbers[last] = -1 - np.arange(len(sizes))
    ids = mix(numbers.view(U64) + U64(0x9E3779B97F4A7C15))
    t = 1
    while True:
        wide = sizes >= PERIODS * t
        if not wide.any():
            break
        keep = wide[text]
        if not keep.all():
            numbers, ids, text = numbers[keep], ids[keep], text[keep]
        base = np.searchsorted(text, np.arange(len(sizes)))
        doubled = mix(ids * U64(0x100000001B3) + U64(1))
        doubled[:-t] = mix(ids[:-t] * U64(0x100000001B3) + ids[t:])
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        for i, start, length, period in runs:
            if 4 * period <= t <= length and wide[i]:
                edge[base[i] + start] += 1
                edge[base[i] + start + length - t + 1] -= 1
        at = selected(ids, np.cumsum(edge[:-1]) > 0, t)
        covered = (0, 0)  # a period and the end of the stretch last followed
        for period, place in zip(*(x.tolist() for x in proposals(doubled, at, t))):
            if covered[0] == period and place < covered[1]:
                continue
            right = _agree(numbers, place, period, 1)
            left = _agree(numbers, place - 1, period, -1) if place else 0
            covered = (period, place + right)
            length = left + right + period
            if right and length >= PERIODS * period:
                i = int(text[place])
                runs.append((i, place - left - int(base[i]), length, period))
        ids = doubled
        t *= 2
    found = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    return found


def _chunks(sizes: list[int]):
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > CHUNK_WORDS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _batch_runs(texts: list[bytes], min_length: int):
    """For each text: its runs by start and period, and its kept words joined by one space."""
    split = [t.split() for t in texts]
    for begin, end in _chunks([len(w) for w in split]):
        number = defaultdict(count().__next__)
        part = split[begin:end]
        first = np.concatenate([[0], np.cumsum([len(w) for w in part])]).astype(np.int64)
        words = np.fromiter((number[x] for w in part for x in w), np.int64, int(first[-1]))
        runs = find_runs(words, first)
        runs = runs[runs[:, 2] >= min_length]
        bounds = np.searchsorted(runs[:, 0], np.arange(len(part) + 1))
        for i, own in enumerate(part):
            mine = runs[bounds[i]:bounds[i + 1], 1:]
            if len(mine):
                mine = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
                edge = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(edge, mine[:, 0] + mine[:, 2], 1)
                np.add.at(edge, mine[:, 0] + mine[:, 1], -1)
                own = [own[j] for j in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            yield mine, b" ".join(own)


def _task(min_length: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists, kept = [], []
                for mine, text in _batch_runs([t or b"" for t in part.column(1).to_pylist()], min_length):
                    lists.append(mine)
                    kept.append(text)
                flat = np.concatenate(lists)
                values = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(kind))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, values), pa.array(kept, pa.binary())],
                                                 names=["id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6) -> DataFrame:
    """One row a document: ``id``, ``runs`` (start, length and period in words,
    by start and period; of at least ``min_length`` words) and ``collapsed``,
    the words joined by one space without those that stand in a run after its
    first period."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    out = rows.mapInArrow(_task(min_length), "id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
