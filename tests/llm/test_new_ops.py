"""Periodic runs and the Merkle manifest against brute force."""

import random
import zlib

import numpy as np
import pytest

from flowlens.llm.merkle import ranked, merkle_manifest
from flowlens.llm.periodic import find_runs, periodic_runs
from flowlens.llm.queries import op11_periodic_runs, op13_manifest
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ROWS


def runs_of(w, least=6):
    """Every run by its definition, period by period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 4 * q):
                if not any(q % d == 0 and all(w[x] == w[x + d] for x in range(i, i + length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id, text):
    w = brute.WORD.findall(text or "")
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_find_runs_by_definition():
    rnd = random.Random(7)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            n = rnd.choice([0, 1, 3, 4, 5, 8, 13, 30, 60, 150])
            w = [rnd.randrange(rnd.choice([1, 2, 3, 8])) for _ in range(n)]
            if n and rnd.random() < 0.8:
                a = rnd.randrange(n)
                p = rnd.randint(1, max(1, (n - a) // rnd.randint(3, 9)))
                w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
                if rnd.random() < 0.4:
                    w[rnd.randrange(n)] = 99
            texts.append(w)
        first = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        got = find_runs(np.array([x for w in texts for x in w], dtype=np.int64), first)
        assert sorted(map(tuple, got.tolist())) == sorted((i, *r) for i, w in enumerate(texts) for r in runs_of(w, 4))


def test_long_runs_of_every_scale():
    rnd = random.Random(3)
    for q in (1, 2, 3, 5, 64, 100, 1000, 5000):
        w = [10 ** 6 + i for i in range(77)] + [rnd.randrange(50) for _ in range(q - 1)] + [-5]
        w = w[:77] + (w[77:] * 5)[:4 * q] + [10 ** 7 + i for i in range(50)]
        got = find_runs(np.array(w), np.array([0, len(w)]))
        assert (0, 77, 4 * q, q) in set(map(tuple, got.tolist()))


def test_op11_by_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in op11_periodic_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(documents)
    found = 0
    for d in documents:
        w = planted(d["doc_id"], d["text"])
        number = {}
        if len(w) > 1500:  # the plain search is quadratic
            continue
        runs = runs_of([number.setdefault(x, len(number)) for x in w])
        best = max(((n, -s, -q) for s, n, q in runs), default=None)
        want = (None,) * 4 if best is None else (-best[1], best[0], -best[2], 1000 * best[0] // -best[2])
        r = got[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(runs), *want)
        assert r["runs_sha256"] == brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        assert r["collapsed_sha256"] == brute.sha(collapsed(w, runs))
        found += bool(runs)
    assert found >= 10


def test_periodic_runs_odd_rows(spark, odd, empty):
    got = periodic_runs(odd).collect()
    assert len(got) == len(ROWS) and periodic_runs(empty).count() == 0
    by_text = {r["id"]: r for r in got if r["id"] is not None}
    assert by_text[11]["collapsed"] == "word the end" and [tuple(x) for x in by_text[11]["runs"]] == [(0, 30_000, 1)]
    assert all(r["collapsed"] == "" and r["runs"] == [] for r in got if r["id"] in (1, 2, 3))


def test_periodic_runs_very_long_text(spark):
    text = "a b c d e f g " * 300_000 + "z"
    row = periodic_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 2_100_000, 7)] and row["collapsed"] == "a b c d e f g z"


# ---------------------------------------------------------------- manifest

def digest(values):
    return brute.sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves, fan_out=16):
    """(root, siblings of each leaf as (left, right) pairs from the leaf level up)."""
    nodes, paths, places = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(nodes) > 1:
        for i, at in enumerate(places):
            run = at // fan_out * fan_out
            paths[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fan_out])))
            places[i] = at // fan_out
        nodes = [brute.sha("".join(nodes[i:i + fan_out])) for i in range(0, len(nodes), fan_out)]
    return nodes[0], paths


def manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    out, subroots = [], []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        root, paths = tree([digest(r) for r in own])
        subroots.append(root)
        out.append((own, paths))
    root, above = tree(subroots)
    found = []
    for (own, paths), subroot, upper in zip(out, subroots, above):
        for r, path in zip(own, paths):
            path = path + upper
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                seen = (*r[:4], r[4].translate(brute.UPPER))
            h = digest(seen)
            for left, right in path:
                h = brute.sha(left + h + right)
            found.append((r[0], digest(r), subroot, root, brute.sha("".join(a + b for a, b in path)), h, h == root))
    return found


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_op13_by_brute_force(spark, documents):
    got = op13_manifest(spark, SF_SMALL).collect()
    want = manifest([(d["doc_id"], d["source"], d["lang"], d["n_chars"], d["text"]) for d in documents])
    same(got, want)
    assert 0 < sum(not r["verified"] for r in got) < len(got) / 3


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 257])
def test_manifest_sizes_and_sources(spark, n, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"s{i % 40}" if i > 20 else "hot", None, i, f"Text {i}" if i % 5 else "") for i in range(n)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    path = f"{tmp_path}/documents.parquet"
    frame.write.parquet(path)
    same(op13_manifest(spark, str(tmp_path)).collect(), manifest(rows))


def test_manifest_of_several_tiers(spark):
    """More than one block of leaves, and more than one of groups."""
    rows = [(i, "big" if i < 9_000 else f"g{i:06d}", "x") for i in range(14_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(16)
    got = merkle_manifest(frame, ["doc_id", "text"]).select("id", "leaf", "subroot", "root", "folded_root", "verified").collect()
    big, _ = tree([digest((i, "x")) for i in range(9_000)])
    root, _ = tree([big] + [digest((i, "x")) for i in range(9_000, 14_000)])
    assert len(got) == 14_000 and {r["root"] for r in got} == {root} and all(r["verified"] for r in got)
    assert {r["subroot"] for r in got if r["id"] < 9_000} == {big}


def test_manifest_odd_rows(spark, odd, empty):
    got = merkle_manifest(odd, ["doc_id", "text"]).collect()
    assert len(got) == len(ROWS) and all(r["verified"] for r in got)
    twice = [r["leaf"] for r in got if r["id"] == 5]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert merkle_manifest(empty, ["doc_id", "text"]).count() == 0


def test_ranks_of_a_hot_group(spark):
    """Ranks are places in the whole order, whichever tasks the group is dealt over."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'b', 'a') AS grp", "if(id % 4 = 0, null, pmod(id * 7919, 30011)) AS id", "id AS h")
    got = [tuple(r) for r in ranked(rows, "grp", ["id", "h"]).collect()]
    for g in "ab":
        own = sorted((r for r in got if r[0] == g), key=lambda r: r[3])
        assert [r[3] for r in own] == list(range(len(own))) and {r[4] for r in own} == {len(own)}
        key = [(r[1] is not None, r[1] or 0, r[2]) for r in own]
        assert key == sorted(key)
