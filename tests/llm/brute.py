"""Plain versions of the operators, one row at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def crc(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def shingles(text, k):
    w = words(text)
    return [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def components(n, linked):
    """Smallest index reachable from each of ``range(n)``."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def simhash(text, k=3):
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, k)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def simhash_components(docs, k=3, bits=3):
    docs = sorted(docs)
    prints = [simhash(t, k) for _, t in docs]
    root = components(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= bits)
    return {(d, f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, root)}


def line_dedup(docs, min_chars=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    held = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(d)
    rank = lambda d: (d is not None, d or 0)
    keeper = {k: max(v, key=rank) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def substring_dedup(docs, length=100):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def contained(docs, items, k=5, threshold=0.8):
    out = set()
    own = [(d, set(shingles(t, k))) for d, t in docs]
    for i, t in items:
        s = set(shingles(t, k))
        out |= {(d, i, len(s & o), len(s), len(s & o) / len(s)) for d, o in own if s and len(s & o) / len(s) >= threshold}
    return out


def source_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """The rule as stated: share by weight, cut at the cap, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_names, left = {}, set(names), share * sum(sizes.values())
    while open_names:
        total = sum(weight[s] for s in open_names)
        want = {s: left * weight[s] / total for s in open_names}
        over = [s for s in open_names if want[s] >= cap * sizes[s]]
        if not over:
            return target | want
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_names.remove(s)
    return target


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = {}
    for kind, pattern in PII.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out[kind].append(m.span())
    return out


def next_texts(docs):
    """Each row with the next one's text, by descending id (nulls last), then by text."""
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    return [(d, t or "", rows[(i + 1) % len(rows)][1] or "") for i, (d, t) in enumerate(rows)]
