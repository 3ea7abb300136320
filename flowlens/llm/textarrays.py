"""Texts as byte arrays: words, word hashes and shingles without a Python loop a word.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z
lower-cased. A word's hash is a polynomial of its bytes modulo 2^64, mixed;
equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are worked on at once (one longer text is worked on alone).
CHUNK_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse (kept a process)."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=U64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and the ``n + 1`` offsets into them; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of at most ``limit`` bytes: (first, end, bytes, offsets)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        a, b = offsets[first], offsets[end]
        yield first, end, data[a:b], offsets[first:end + 1] - a
        first = end


class Words:
    """The words of some texts: hashes, byte bounds, text numbers."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.low = LOWER[data]
        inside = IS_WORD[data]
        start = inside.copy()
        if len(data):
            start[1:] &= ~inside[:-1]
            bounds = offsets[:-1][offsets[:-1] < len(data)]
            start[bounds] = inside[bounds]
        self.starts = np.flatnonzero(start)
        stop = inside.copy()
        if len(data):
            stop[:-1] &= ~inside[1:]
            bounds = offsets[1:][offsets[1:] > 0] - 1
            stop[bounds] = inside[bounds]
        self.stops = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.starts, offsets)  # text i has words first[i]:first[i+1]
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._inside = inside

    def sums(self) -> np.ndarray:
        """Running sum of byte value x power, for hashes of any stretch of a word."""
        up, _ = powers(len(self.low))
        run = np.zeros(len(self.low) + 1, dtype=U64)
        np.cumsum(np.where(self._inside, (self.low.astype(U64) + U64(1)) * up, U64(0)), dtype=U64, out=run[1:])
        return run

    def hashes(self, run: np.ndarray | None = None, prefix: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``prefix`` bytes."""
        run = self.sums() if run is None else run
        _, down = powers(len(self.low))
        stops = self.stops if prefix is None else np.minimum(self.stops, self.starts + prefix)
        return mix((run[stops] - run[self.starts]) * down[self.starts])

    def shingles(self, k: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``k``-word shingles that lie in one text, and their first words."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        h = np.zeros(n, dtype=U64)
        for j in range(k):
            h = h * U64(0x100000001B3) + hashes[j:j + n]
        at = np.flatnonzero(self.text[:n] == self.text[k - 1:])
        return mix(h[at]), at

    def words_text(self, first: int, k: int) -> str:
        """Words ``first`` to ``first + k - 1``, joined by one space."""
        return b" ".join(self.low[a:b].tobytes() for a, b in
                         zip(self.starts[first:first + k], self.stops[first:first + k])).decode("utf-8", "replace")
