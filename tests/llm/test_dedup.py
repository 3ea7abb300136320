"""Line, substring and SimHash deduplication against brute force."""

import numpy as np
import pytest

from flowlens.llm import simhash, suffix_dedup
from flowlens.llm.line_dedup import build_mph, line_dedup, mph_index
from flowlens.llm.queries import QUERIES
from flowlens.llm.textarrays import U64
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import LONG, ROWS

PAIRS = [(r[0], r[1]) for r in ROWS]
sort = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_perfect_hash_is_minimal_and_complete():
    rng = np.random.default_rng(1)
    h1, h2 = rng.integers(0, 2**63, 5000).astype(U64), rng.integers(0, 2**63, 5000).astype(U64)
    h1[:50] = 7  # told apart by the second half alone
    sizes, words = build_mph(h1, h2)
    assert sorted(mph_index(sizes, words, h1, h2).tolist()) == list(range(5000))
    assert build_mph(h1[:0], h2[:0])[0] == []


def test_line_query(spark, documents):
    got = {(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op7_line_dedup"](spark, SF_SMALL).collect()}
    assert got == {(d, n, m, brute.sha(t)) for d, n, m, t in brute.line_dedup([(r.doc_id, r.text) for r in documents])}
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("shard_keys,cell_rows", [(50_000, 200_000), (1, 2)])
def test_line_odd_rows(odd, shard_keys, cell_rows):
    out = line_dedup(odd, min_docs=4, shard_keys=shard_keys, cell_rows=cell_rows)
    assert out.columns == ["doc_id", "text", "lang", "source", "score", "range", "flagged", "n_lines", "n_dropped"]
    assert sort((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()) == sort(brute.line_dedup(PAIRS, min_docs=4))


def test_line_null_id_counts_as_one_document(spark):
    rows = [(None, LONG), (None, LONG), (1, LONG), (2, LONG)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sort((r.doc_id, r.n_dropped) for r in line_dedup(docs, min_docs=3).collect()) == sort([(None, 1), (None, 1), (1, 1), (2, 0)])
    assert sum(r.n_dropped for r in line_dedup(docs, min_docs=4).collect()) == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for text in (rng.integers(97, 99, 400).astype(np.uint8), np.full(300, 97, np.uint8), np.zeros(1, np.uint8)):
        words = suffix_dedup.first_bytes(text)
        sa = suffix_dedup.suffix_array(text, words)
        raw = text.tobytes()
        assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])

        def shared(a, b):
            return next((k for k in range(100) if raw[a + k:a + k + 1] != raw[b + k:b + k + 1] or a + k >= len(raw) or b + k >= len(raw)), 100)

        want = [0] + [shared(a, b) for a, b in zip(sa[:-1], sa[1:])]
        assert suffix_dedup.common_prefixes(text, sa, words, 100).tolist() == want


def test_substring_query(spark, documents):
    got = {tuple(r) for r in QUERIES["op6_substring_dedup"](spark, SF_SMALL).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == {(*r[:4], brute.sha(r[4])) for r in brute.substring_dedup([(r.doc_id, r.text) for r in documents])}
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("shard_bytes", [1 << 22, 64])
def test_substring_odd_rows(spark, odd, shard_bytes):
    passage = "".join(chr(97 + i * i % 26) for i in range(150))
    more = [(20, f"é{passage}tail"), (21, f"another head {passage}"), (22, passage[:99]), (23, f"{passage}|{passage}\0"), (22, passage[:99]), (None, passage)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    out = suffix_dedup.substring_dedup(docs, shard_bytes=shard_bytes).collect()
    want = brute.substring_dedup(PAIRS + more)
    assert sort((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out) == sort(want)
    assert sum(r[2] for r in want) > 150_000


def test_substring_long_document_in_pieces(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = "".join(map(chr, rng.integers(97, 123, 3000)))
    rows = [(1, base[:1500]), (2, base[700:] + base[:400])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sort(brute.substring_dedup(rows))
    data = np.frombuffer((base * 2).encode(), np.uint8)
    monkeypatch.setattr(suffix_dedup, "PIECE", 512)  # in this process; tasks get functions by value
    parts = list(suffix_dedup.pieces(data, np.array([0, len(data)]), 100))
    assert max(len(p[0]) for p in parts) <= 512 and sum(len(p[0]) - 99 for p in parts) == len(data) - 99
    assert sort((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.substring_dedup(docs).collect()) == want


def test_simhash_query(spark, documents):
    got = {tuple(r) for r in QUERIES["op3_simhash"](spark, SF_SMALL).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == brute.simhash_components([(r.doc_id, r.text) for r in documents])


def test_simhash_odd_rows(odd):
    out = simhash.simhash_components(odd).collect()
    assert len(out) == len(ROWS)
    by_text = {}
    for (d, t), r in zip(sort(PAIRS), sort((x.id, x.component, x.fp) for x in out)):
        by_text.setdefault(brute.simhash(t), set()).add(r[1])
    for row in out:
        want = [d for d, t in PAIRS if d is not None and (brute.simhash(t) ^ (row.fp % 2**64)).bit_count() <= 3]
        assert row.component == (min(want) if want else None)


@pytest.mark.parametrize("max_bits,sample_rows,shard_rows", [(3, 512, 64), (5, 64, 40), (0, 128, 32)])
def test_vantage_point_links_are_exact(spark, max_bits, sample_rows, shard_rows):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60).astype(U64)
    prints = {0, 2**64 - 1}
    for x in base.tolist():
        for _ in range(12):
            y = x
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                y ^= 1 << int(b)
            prints.add(y)
    for i in range(120):  # one tight cluster
        prints.add(int(base[0]) ^ (1 << (i % 64)) ^ (1 << (i * 7 % 64)))
    prints = sorted(prints)
    rows = [(int(np.uint64(x).astype(np.int64)),) for x in prints]
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "fp bigint"), max_bits, sample_rows, shard_rows).collect()
    at = {r[0]: i for i, r in enumerate(rows)}
    pairs = {(max(at[r.a], at[r.b]), min(at[r.a], at[r.b])) for r in links}
    assert all((prints[i] ^ prints[j]).bit_count() <= 64 for i, j in pairs)
    want = brute.components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= max_bits)
    assert brute.components(len(prints), lambda i, j: (i, j) in pairs) == want


def test_local_trees_lose_no_link():
    rng = np.random.default_rng(5)
    points = np.unique(rng.integers(0, 2**16, 3000).astype(U64) << U64(24))  # both halves partly alike
    forest = simhash.Forest(len(points))
    simhash.link_close(points, np.arange(len(points)), np.ones(len(points), bool), [(simhash.HALVES[0], 1), (simhash.HALVES[1], 1)][:1] + [(U64(2**64 - 1), 3)], 3, forest, leaf_rows=32)
    low = points & simhash.HALVES[0]
    near = [(i, j) for i in range(0, len(points), 7) for j in np.flatnonzero((np.bitwise_count(points ^ points[i]) <= 3) & (np.bitwise_count(low ^ low[i]) <= 1))]
    root = forest.find(np.arange(len(points)))
    assert all(root[i] == root[j] for i, j in near) and len(near) > 500


def test_bits_over_many_hashes():
    rng = np.random.default_rng(6)
    sizes = [0, 1, 2, 255, 256, 1000, 0]
    hashes = [rng.integers(0, 2**63, n).astype(U64) << U64(1) for n in sizes]
    got = simhash.majority_bits(np.concatenate(hashes), np.concatenate([[0], np.cumsum(sizes)]))
    assert got.tolist() == [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h)) if len(h) else 0 for h in hashes]


def test_empty_tables(empty):
    assert line_dedup(empty).count() == 0
    assert suffix_dedup.substring_dedup(empty).count() == 0
    assert simhash.simhash_components(empty).count() == 0


def test_components(spark):
    from flowlens.llm.components import connected_components

    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 90, 95: 90, 201: 200}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
