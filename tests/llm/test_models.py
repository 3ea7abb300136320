"""Toxicity, language and personal data: held-out accuracy, gradients and exact parts."""

import itertools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import langid, pii, toxicity
from flowlens.llm.queries import QUERIES, remainder
from flowlens.llm.textarrays import Words, text_buffers
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ROWS


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["One  two\tONE", "", None, "é two", "x" * 50, "\n"]
    data, offsets = text_buffers(pa.array(texts))
    words = Words(data, offsets)
    flat = [w for t in texts for w in brute.words(t)]
    assert [words.words_text(i, 1) for i in range(len(flat))] == flat
    assert np.diff(words.first).tolist() == [len(brute.words(t)) for t in texts]
    h = words.hashes().tolist()
    assert all((a == b) == (x == y) for (a, x), (b, y) in itertools.combinations(zip(h, flat), 2))
    p = words.hashes(prefix=2).tolist()
    assert all((a == b) == (x.encode()[:2] == y.encode()[:2]) for (a, x), (b, y) in itertools.combinations(zip(p, flat), 2))
    grams, at = words.shingles(2, words.hashes())
    assert [words.words_text(i, 2) for i in at] == [s for t in texts for s in brute.shingles(t, 2) if " " in s]
    assert len(set(grams.tolist())) == len(grams)


# ---------------------------------------------------------------- toxicity

def test_toxicity_held_out(spark):
    got = QUERIES["op2_toxicity"](spark, SF_CHECK).join(spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (brute.crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == r.toxic for r in held]) > 0.9


def test_toxicity_ignores_other_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    fitted = toxicity.fit(docs, labels, remainder("doc_id", 5) != 0)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", -F.col("doc_id"))
    a = sorted((r.doc_id, r.score) for r in toxicity.score_toxicity(docs, fitted).collect())
    b = sorted((-r.doc_id, r.score) for r in toxicity.score_toxicity(other, fitted).collect())
    assert a == b


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (9, 0), (10, None), (None, 1), (11, 0), (77, 1), (8, 5)], "doc_id bigint, toxic int")
    fitted = toxicity.fit(odd, labels, F.lit(True))
    out = toxicity.score_toxicity(odd, fitted)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_lines", "range", "score", "predicted", "threshold", "flagged"]
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not brute.words(r.text)}) == 1
    assert toxicity.score_toxicity(empty, fitted).count() == 0
    for nothing in (labels.limit(0), labels.where("toxic = 1")):
        assert toxicity.fit(odd, nothing, F.lit(True)) is None
    assert {r.score for r in toxicity.score_toxicity(odd, None).collect()} == {0.0}


def test_pooling_is_the_maximum_over_windows():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 2, 5, 0, 3]
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = rng.normal(size=(first[-1], sum(toxicity.WIDTHS), toxicity.FILTERS))
    best, _ = toxicity.pooled(values, first)
    for t, n in enumerate(sizes):
        tap = 0
        for w, width in enumerate(toxicity.WIDTHS):
            own = [sum(values[first[t] + i + j, tap + j] for j in range(width)) for i in range(n - width + 1)]
            want = np.max(own, axis=0) if own else np.full(toxicity.FILTERS, -np.inf)
            assert np.allclose(best[t, w * toxicity.FILTERS:(w + 1) * toxicity.FILTERS], want)
            tap += width


def test_best_cut():
    assert 2 < toxicity.best_cut(np.array([0.0, 1, 2, 5, 6]), np.array([0, 0, 0, 1, 1.0])) < 5
    assert toxicity.best_cut(np.array([1.0, 1.0]), np.array([0, 1.0])) < 1


def labelled(spark, n, lang_of, toxic_of, before=""):
    """Documents of clean words, with a bad one in the toxic ones, and their labels."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, before + " ".join([*rng.choice(words, 12), *(["vile"] if toxic_of(i) else [])]), lang_of(i)) for i in range(n)]
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
            spark.createDataFrame([(i, int(toxic_of(i))) for i in range(n)], "doc_id bigint, toxic int"))


def test_thresholds_from_all_labelled_rows(spark):
    """A language that is rare in the bounded sample has labels enough outside of it."""
    docs, labels = labelled(spark, 3000, lambda i: "fr" if i % 20 < 2 else "en", lambda i: i % 4 == 0)
    fitted = toxicity.fit(docs, labels, F.lit(True), sample_rows=40)
    assert set(fitted["thresholds"]) == {"en", "fr"}


def test_thresholds_of_a_rare_language_are_cross_fitted(spark):
    docs, labels = labelled(spark, 700, lambda i: "fr" if i % 20 < 2 else "xx" if i == 2 else "en", lambda i: i % 4 == 0)  # fr: 35 toxic, about 7 not learnt from
    fitted = toxicity.fit(docs, labels, F.lit(True))
    assert set(fitted["thresholds"]) == {"en", "fr"}
    rows = toxicity.score_toxicity(docs, fitted).collect()
    assert np.mean([r.flagged == (r.doc_id % 4 == 0) for r in rows]) > 0.95


def test_toxicity_learns_from_whole_texts(spark):
    docs, labels = labelled(spark, 120, lambda i: "en", lambda i: i % 2 == 0, before="w0 w1 w2 " * 1_400)
    rows = toxicity.score_toxicity(docs, toxicity.fit(docs, labels, F.col("doc_id") < 90)).collect()
    assert np.mean([r.predicted == (r.doc_id % 2 == 0) for r in rows if r.doc_id >= 90]) > 0.9
    assert toxicity.fit(docs, labels, F.lit(True), sample_bytes=100_000) is not None


def test_cut_of_counts_is_the_cut_of_the_values():
    rng = np.random.default_rng(6)
    values, labels = np.round(rng.normal(size=300), 1), rng.integers(0, 2, 300).astype(float)
    allowed = sorted(set(values))
    cuts = [allowed[0] - 1, *((a + b) / 2 for a, b in zip(allowed, allowed[1:])), allowed[-1] + 1]
    f1 = [2 * labels[values >= c].sum() / ((values >= c).sum() + labels.sum()) for c in cuts]
    assert math.isclose(max(f1), 2 * labels[values >= toxicity.best_cut(values, labels)].sum() / ((values >= toxicity.best_cut(values, labels)).sum() + labels.sum()))


# ---------------------------------------------------------------- language

def test_language_held_out(spark):
    got = QUERIES["op8_language"](spark, SF_CHECK).join(spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (brute.crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert len(held) > 200 and np.mean([r.lang_pred == r.lang for r in held]) > 0.98


def test_automaton_accepts_exactly_the_substrings():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 3, 40).tolist()
    step = langid.suffix_automaton(text)

    def accepts(s):
        at = 0
        for c in s:
            if c not in step[at]:
                return False
            at = step[at][c]
        return True

    known = {tuple(text[i:j]) for i in range(41) for j in range(i, 41)}
    assert all(accepts(s) == (tuple(s) in known) for n in range(6) for s in itertools.product(range(3), repeat=n))
    assert accepts(text) and len(step) <= 80


def test_phrases_by_definition():
    rng = np.random.default_rng(2)
    training = [rng.integers(0, 4, 60).astype(np.uint8), rng.integers(0, 3, 50).astype(np.uint8)]
    table, starts = langid.automata_table(training, 6)
    pieces = [rng.integers(0, 6, n).astype(np.uint8) for n in (1, 30, 7, 100)]

    def phrases(piece, text):
        known, n, match = {tuple(text[i:j].tolist()) for i in range(len(text)) for j in range(i, len(text) + 1)}, 1, ()
        for c in piece.tolist():
            if (*match, c) in known:
                match = (*match, c)
            else:
                n += 1
                match = (c,) if (c,) in known else ()
        return n

    got = langid.count_phrases(pieces, table, starts, 6)
    assert got.tolist() == [[phrases(p, t) for t in training] for p in pieces]


def test_language_odd_rows(odd, empty):
    fitted = langid.fit(odd, F.lit(True))
    out = langid.identify_language(odd, fitted)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_lines", "range", "flagged", "lang_pred", "score"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and 0 <= r.score <= 1 for r in rows)
    assert langid.identify_language(empty, fitted).count() == 0
    assert langid.fit(empty, F.lit(True)) is None
    assert {r.lang_pred for r in langid.identify_language(odd, None).collect()} == {"und"}
    one = langid.fit(odd.where("lang = 'fr'"), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.identify_language(odd.where("doc_id = 4"), one).collect()} == {("fr", 1.0)}


# ---------------------------------------------------------------- personal data

TEXTS = [
    "a@b", "a@b.c", "x a.b+c@d-e.f.g. y", "@a.b", "aa@@b.c", "a@b.c@d.e", "a@b..c", "é@b.cd", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1",
    "0001.002.3.4", "1..2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111x", "4111111111111112", "41111111111111114111111111111111",
    "+1 (743) 555-3824", "+1(743)5553824 ", "++14155550123", "+1 2 3", "+123456789012345 6", "+1-", "call +44 20 7946 0958.", "9" * 300 + "." + "1" * 5000, "a" * 3000 + "@" + "b" * 3000 + ".c",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    if len(text) < 1000:
        assert pii.base_spans(text) == brute.base_spans(text)
    else:
        pii.base_spans(text)


def test_personal_data_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op4_personal_data"](spark, SF_SMALL).collect()}
    for d in documents:
        base = brute.base_spans(d.text)
        text = ",".join(f"{k}:{a}:{b}" for k, own in base.items() for a, b in own)
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == (*(len(own) for own in base.values()), brute.sha(text))
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(",")) and len(spans) == r.n_added + sum(map(len, base.values()))
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), int(s[1])))


def test_gradient_matches_differences():
    text, gold = "call 743 555-3824 x9", {(2, 7, 3)}
    lattice = pii.Lattice(text)
    rng = np.random.default_rng(0)
    features = sorted({f for own in lattice.segments for _, fs in own for f in fs})
    weights = {f: rng.normal(0, 0.3, 4).tolist() for f in features}

    def likelihood():
        def paths(end):  # every segmentation, by its score and entities
            if end == 0:
                return [(0.0, frozenset())]
            out = paths(end - 1)
            for start, fs in lattice.segments[end]:
                scores = pii._scores(fs, weights)
                out = out + [(s + x, own | {(start, end, k)}) for s, own in paths(start) for k, x in enumerate(scores)]
            return out

        every = paths(lattice.n)
        return next(s for s, own in every if own == gold) - math.log(sum(math.exp(s) for s, _ in every)), every

    value, every = likelihood()
    got = pii.gradient(lattice, gold, weights)
    for f in features[:: max(1, len(features) // 6)]:
        weights[f][3] += 1e-5
        up, _ = likelihood()
        weights[f][3] -= 1e-5
        assert abs((up - value) / 1e-5 - got.get(f, [0] * 4)[3]) < 1e-3
    best = max(every, key=lambda p: p[0])[1]
    assert {(a, b, k) for a, b, k in pii.decode(text, weights)} == {(lattice.bounds[a], lattice.bounds[b], pii.KINDS[k]) for a, b, k in best}


def test_model_adds_phone_numbers_without_a_plus(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    weights = pii.fit(docs)
    base, added = pii.find_spans("so call 1 (743) 555-3824 or +1 (310) 555-4510 today", weights, {})
    assert base["phone"] == [(28, 45)] and added["phone"] == [(8, 24)]
    assert not any(pii.find_spans("in 1999 there were 12 of 345 items at 10:30", weights, {})[1].values())


def test_personal_data_odd_rows(odd, empty):
    weights = pii.fit(odd)
    out = pii.find_personal_data(odd, weights)
    rows = {r.doc_id: r for r in out.collect()}
    assert len(out.collect()) == len(ROWS) and rows[12].n_email == 1 and rows[12].n_phone == 1
    assert rows[1].spans == "" and re.fullmatch(r"email:5:\d+,phone:\d+:\d+", rows[12].spans)
    assert pii.find_personal_data(empty, pii.fit(empty)).count() == 0
