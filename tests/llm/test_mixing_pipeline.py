"""Mixing, and the pipeline's stages against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowlens.llm.mixing import cube_flight, cube_landing, mix_sources
from flowlens.llm.queries import QUERIES, remainder
from flowlens.llm.simhash import simhash_components
from flowlens.llm.toxicity import fit, score_toxicity
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ROWS


def totals(docs):
    sizes = {}
    for source, text in docs:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    return sizes


def check_mix(rows, docs):
    """``docs``: (id, source, text). Targets by the rule; totals near them."""
    sizes = totals((s, t) for _, s, t in docs)
    want = brute.source_targets(sizes)
    by = sorted(((d is None, d or 0), len(brute.words(t)), sizes[s], round(want[s], 6)) for d, s, t in docs)
    assert sorted(((r.id is None, r.id or 0), r.size, r.source_size, round(r.target, 6)) for r in rows) == by
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)


def test_mix_query(spark, documents):
    rows = QUERIES["op5_mixing"](spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    check_mix(rows, [(r.doc_id, r.source, r.text) for r in documents])
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op5_mixing"](spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()))


@pytest.mark.parametrize("bucket_rows,fan_in", [(4000, 5000), (40, 3)])
def test_mix_totals(spark, bucket_rows, fan_in):
    rng = np.random.default_rng(0)
    rows = [(i, "big" if i % 3 else f"s{i % 9}", "w " * int(rng.integers(1, 60))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    out = mix_sources(docs, bucket_rows=bucket_rows, fan_in=fan_in).collect()
    check_mix(out, rows)
    source = {i: s for i, s, _ in rows}
    for s in set(source.values()):
        own = [r for r in out if source[r.id] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 60 * 2
        assert abs(sum(r.copies for r in own) - len(own) * own[0].target / own[0].source_size) <= 2


def test_mix_odd_rows(spark, odd, empty):
    check_mix(mix_sources(odd).collect(), [(r[0], r[3], r[1]) for r in ROWS])
    assert mix_sources(empty).count() == 0
    blank = mix_sources(odd.where("doc_id in (2, 3)")).collect()
    assert [(r.size, r.taken, r.copies) for r in blank] == [(0, 0, 1)] * 2


def test_cube_is_balanced_and_unbiased():
    sizes = [9, 7, 7, 5, 4, 4, 3, 2, 2, 1]
    taken = np.zeros(len(sizes))
    rng = np.random.default_rng(0)
    for _ in range(4000):
        p = [0.3] * len(sizes)
        draws = iter(lambda: float(rng.random()), None)
        left = cube_flight(p, sizes, draws)
        assert len(left) <= 2 and abs(sum(p) - 3) < 1e-6 and abs(sum(a * b for a, b in zip(p, sizes)) - 0.3 * sum(sizes)) < 1e-6
        cube_landing(p, sizes, left, draws)
        assert set(p) <= {0.0, 1.0}
        taken += p
    assert np.abs(taken / 4000 - 0.3).max() < 0.04


def test_pipeline_stages(spark, documents):
    """Each stage on its own input, by brute force."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, stage = docs.columns, dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))

    fitted = fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"), remainder("doc_id", 5) != 0)
    toxic = {r.doc_id for r in score_toxicity(docs, fitted).where("flagged").collect()}
    one = stage["toxicity"](spark, docs, SF_SMALL)
    assert rows(one) == sorted(tuple(d) for d in documents if d.doc_id not in toxic) and toxic

    two = stage["line dedup"](spark, one, SF_SMALL)
    cut = {d: t for d, _, _, t in brute.line_dedup([(r.doc_id, r.text) for r in one.collect()])}
    assert rows(two) == sorted((r.doc_id, cut[r.doc_id], r.lang, r.source, len(cut[r.doc_id])) for r in one.collect())

    three = stage["SimHash near-dedup"](spark, two, SF_SMALL)
    kept = {d for d, _, c in brute.simhash_components([(r.doc_id, r.text) for r in two.collect()]) if c == d}
    assert rows(three) == [r for r in rows(two) if r[0] in kept]

    four = stage["benchmark decontamination"](spark, three, SF_SMALL)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {x[0] for x in brute.contained([(r.doc_id, r.text) for r in three.collect()], bench)}
    assert rows(four) == [r for r in rows(three) if r[0] not in leaks]

    five = stage["mixing sources"](spark, four, SF_SMALL).collect()
    want = brute.source_targets(totals((r.source, r.text) for r in four.collect()))
    assert all(abs(r.target - want[r.source]) < 1e-6 and r.copies > 0 and r.taken == r.copies * len(brute.words(r.text)) for r in five)
    assert {tuple(r)[:5] for r in five} <= {tuple(r) for r in four.collect()}


def test_pipeline_query_is_the_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    got = QUERIES["pipeline"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect())) and got.columns == docs.columns


def test_pipeline_stages_odd_rows(spark, odd, empty):
    shape = lambda df: df.select("doc_id", "text", "lang", "source", F.length("text").cast("bigint").alias("n_chars"), F.lit(1).alias("copies"))
    for start in (shape(odd), shape(empty)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, start, SF_SMALL)
            if name == "mixing sources":
                assert out.count() <= start.count()
            else:
                assert out.columns == start.columns
                start = spark.createDataFrame(out.collect(), out.schema)


def test_pipeline_rows_without_an_id_of_their_own(spark):
    """Null and repeated ids: every text that is nobody's near-duplicate reaches the mix."""
    rng = np.random.default_rng(3)
    text = lambda: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(60))
    plain, copy = [text() for _ in range(40)], text()
    rows = [(None if i % 3 == 0 else i // 2, t, "en", "ab"[i % 2]) for i, t in enumerate(plain)]
    rows += [(900, copy, "en", "a"), (901, copy, "en", "a"), (901, plain[0] + " tail", "en", "b"), (None, copy, "en", "a")] + [(None, copy, None, "a")] * 2
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    groups = {r.id: r.component for r in simhash_components(docs.select(F.monotonically_increasing_id().alias("doc_id"), "text").checkpoint()).collect()}
    stage = dict(corpus_pipeline.STAGES)
    three = stage["SimHash near-dedup"](spark, docs, SF_SMALL).checkpoint()
    assert three.columns == docs.columns and three.count() == len(set(groups.values()))
    assert set(plain[1:]) <= {r.text for r in three.collect()}
    assert [r.doc_id for r in three.where(F.col("text") == copy).collect()] == [900]
    four = stage["benchmark decontamination"](spark, three.unionByName(docs.where(F.col("text") == copy)), SF_SMALL)
    assert four.count() == three.count() + 5
    five = stage["mixing sources"](spark, docs.withColumn("source", F.lit("a")), SF_SMALL).collect()  # of one source every document is taken
    assert sorted((r.doc_id or -1, r.text) for r in five) == sorted((r[0] or -1, r[1]) for r in rows)
