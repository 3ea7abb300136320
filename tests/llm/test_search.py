"""Decontamination, winnowing and licences against brute force and SQL."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlens.llm import winnow
from flowlens.llm.decontam import allowed_misses, contained_items, sketch_length
from flowlens.llm.license_scan import TEMPLATES, THRESHOLD, license_scan, template_terms
from flowlens.llm.queries import QUERIES, SQL
from tests.compare import compare
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ROWS


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck_small, name):
    problems, n = compare(QUERIES[name](spark, SF_SMALL), duck_small, SQL[name])
    assert not problems and n > 0, problems


def test_sketch_cannot_miss():
    for n in range(1, 400):
        m = sketch_length(n, 0.8)
        assert allowed_misses(n, 0.8) < m <= n


def test_contained_items_odd_rows(spark, odd):
    items = [(1, "word " * 6), (2, "one"), (3, "one two"), (4, None), (5, ""), (None, "A common line that several documents of"),
             (6, "A COMMON line\tthat several documents of other"), (6, "one"), (7, "the end"), (8, "several documents of this small table share. last")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in contained_items(odd, bench).select("id", "item", "n_shared", "n_item", "containment").collect()}
    want = brute.contained([(r[0], r[1]) for r in ROWS], [i for i in items])
    best = {}
    for d, i, *rest in want:
        best[d, i] = max(best.get((d, i), (0,)), (rest[2], rest[0], rest[1]))
    assert got == {(d, i, b[1], b[2], b[0]) for (d, i), b in best.items()}
    assert len(got) >= 8


def test_shared_phrase_gives_no_pairs(spark):
    """Documents and items that share one phrase meet in no join: it is in no sketch."""
    phrase = "in the text above find"
    tail = lambda kind, i: " ".join(f"{kind}{i}x{j}" for j in range(30))
    items = spark.createDataFrame([(i, f"{phrase} {tail('q', i)}") for i in range(300)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"{phrase} {tail('d', i)}") for i in range(300)] + [(1000, f"see {phrase} {tail('q', 7)} end")], "doc_id bigint, text string")
    from flowlens.llm.decontam import item_sketches

    rows = item_sketches(items.selectExpr("item_id AS id", "text"), 5, 0.8)
    assert rows.where(F.col("shingle") == phrase).count() == 300
    assert rows.where((F.col("shingle") == phrase) & F.col("in_sketch")).count() == 0
    assert [tuple(r) for r in contained_items(docs, items).select("id", "item").collect()] == [(1000, 7)]


def test_contained_items_empty(spark, odd, empty):
    bench = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    assert contained_items(empty, bench).count() == 0
    assert contained_items(odd, bench.limit(0)).count() == 0


def winnowed(text, k, window, gram_hash):
    """Chosen positions by the definition."""
    w = brute.WORD.findall((text or "").lower())
    grams = [gram_hash(tuple(w[i:i + k])) for i in range(max(1, len(w) - k + 1))] if w else []
    out = []
    for i in range(max(1, len(grams) - window + 1) if grams else 0):
        own = grams[i:i + window]
        at = i + max(j for j, g in enumerate(own) if g == min(own))
        if at not in out:
            out.append(at)
    return out


@pytest.mark.parametrize("k,window", [(5, 16), (2, 3), (1, 1)])
def test_winnowing_follows_the_definition(spark, odd, k, window):
    rows = winnow.with_winnowed(odd.select("doc_id", "text"), "text", "chosen", k, window).collect()
    every = winnow.with_winnowed(odd.select("doc_id", "text"), "text", "all", k, 1).collect()
    value = {}
    for r in every:
        w = brute.WORD.findall((r.text or "").lower())
        for x in r["all"]:
            at = 0xFFFFFFFF - (x & 0xFFFFFFFF)
            assert value.setdefault(tuple(w[at:at + k]), x >> 32) == x >> 32  # equal grams, equal hashes
    for r in rows:
        got = [0xFFFFFFFF - (x & 0xFFFFFFFF) for x in r.chosen]
        assert got == winnowed(r.text, k, window, lambda g: value[g])


def test_winnowing_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(winnow.K + winnow.WINDOW - 1))
    docs = spark.createDataFrame([(1, "alpha beta " + shared + " gamma"), (2, shared), (3, "x y z " + shared)], "doc_id bigint, text string")
    sets = [set(x >> 32 for x in r.chosen) for r in winnow.with_winnowed(docs, "text", "chosen").collect()]
    assert sets[0] & sets[1] & sets[2]


def check_edits(rows, docs):
    got = sorted((r.id is None, r.id or 0, r.n_chars, r.edited) for r in rows)
    want = []
    for d, t, following in brute.next_texts(docs):
        cut = len(t) // 3
        want.append((d is None, d or 0, len(t), t[:len(t) - cut] + following[:cut]))
    assert got == sorted(want)
    for r in rows:
        a, b = ({x >> 32 for x in c} for c in (r.chosen, r.edited_chosen))
        assert r.near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        assert 0 <= r.near_next <= 1


@pytest.mark.parametrize("range_rows", [512, 3])
def test_edits(spark, odd, documents, monkeypatch, range_rows):
    monkeypatch.setattr(winnow, "RANGE_ROWS", range_rows)
    docs = odd.drop("range")
    check_edits(winnow.fingerprints_and_edits(odd).collect(), [(r[0], r[1]) for r in ROWS])
    check_edits(winnow.fingerprints_and_edits(docs.where("doc_id = 4")).collect(), [(4, ROWS[4][1])])
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_edits(winnow.fingerprints_and_edits(table).collect(), [(r.doc_id, r.text) for r in documents])


def test_edits_empty(empty):
    assert winnow.fingerprints_and_edits(empty).count() == 0


def test_native_plans(spark):
    for name in ("op1_license_scan", "op10_winnowing"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))


def test_licences_inherit_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "LICENSE", mit), (2, "src/a.c", "code"), (3, "src/lib/COPYING", "  " + gpl), (4, "src/lib/x/y/z.c", "/* none */"),
            (5, "src/lib/b.c", f"int x;\n// {mit}\n"), (6, None, "code"), (7, None, mit), (8, "src/lib/b.c", None), (1, "LICENSE", mit)]
    files = spark.createDataFrame(rows, "doc_id bigint, path string, text string").withColumn("licence", F.lit(3))
    got = sorted((r.id, r.path, r.licence, r.declared_in) for r in license_scan(files).collect() if r.path)
    assert got == [(1, "LICENSE", "MIT", "LICENSE"), (1, "LICENSE", "MIT", "LICENSE"), (2, "src/a.c", "MIT", ""),
                   (3, "src/lib/COPYING", "GPL-3.0", "src/lib/COPYING"), (4, "src/lib/x/y/z.c", "GPL-3.0", "src/lib"),
                   (5, "src/lib/b.c", "MIT", "src/lib/b.c"), (8, "src/lib/b.c", "GPL-3.0", "src/lib")]
    assert {(r.id, r.licence) for r in license_scan(files).collect() if not r.path} == {(6, None), (7, "MIT")}


def test_licence_empty(empty):
    assert license_scan(empty, path_col="source").count() == 0


def test_licence_terms_weigh_by_their_own_frequencies(spark):
    """The cosine by its definition, over the lines of all files."""
    notices = ["This project is released under the MIT License, see LICENSE.", "Released under the MIT License. Acme Acme Acme Acme Acme",
               "# Copyright 2020 The Foo Authors. Licensed under the Apache License, Version 2.0."]
    prose = ["this project is what we see here", "see this project of 2020, copyright authors", "the is a project"] * 40
    rows = [(i, f"f{i}", t) for i, t in enumerate([*prose, *notices, f"plain\n{notices[0]}"])]
    lines = [(i, n + 1, template_terms(x)) for i, _, t in rows for n, x in enumerate(t.split("\n"))]
    df = Counter(t for _, _, own in lines for t in own)
    idf = lambda t: math.log((1 + len(lines)) / (1 + df[t])) + 1
    vector = lambda own: {t: n * idf(t) for t, n in own.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = {}
    for i, n, own in lines:
        for name, text in TEMPLATES:
            u, v = vector(own), vector(template_terms(text))
            score = round(sum(x * v.get(t, 0) for t, x in u.items()) / norm(u) / norm(v), 6)
            if score >= THRESHOLD and score > want.get(i, (0,))[0]:
                want[i] = (score, name, n)
    got = {r.id: (r.score, r.licence, r.line) for r in license_scan(spark.createDataFrame(rows, "doc_id bigint, path string, text string")).collect() if r.score}
    assert got.keys() == want.keys() and {120, 123} <= set(got) and 121 not in got
    assert all(abs(got[i][0] - want[i][0]) < 2e-6 and got[i][1:] == want[i][1:] for i in got)
    twice = license_scan(spark.createDataFrame([(1, "a", notices[0])] * 2, "doc_id bigint, path string, text string")).collect()
    assert len(twice) == 2 and all(r.score is None or r.score <= 1 for r in twice)
