"""The n-gram Jaccard join against brute force."""

import random

import numpy as np
import pytest

from flowlens.llm.components import _with_least, connected_components
from flowlens.llm.ngram_join import jaccard_components, needed
from flowlens.llm.queries import op12_jaccard_join
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.conftest import ROWS


def expected(rows, k=3, percent=90):
    """(id, n, component) by all pairs."""
    sets = [set(brute.shingles(t, k)) for _, t in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both and 100 * both >= percent * len(sets[i] | sets[j])

    root = brute.components(len(rows), linked)
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(r)) for (d, _), s, r in zip(rows, sets, root)), key=str)


def got(frame, **args):
    return sorted((tuple(r) for r in jaccard_components(frame, **args).collect()), key=str)


def near_copies(rnd, n, base_words=60):
    """Families of texts that differ in a few words, chains of them, and texts that only share passages."""
    bank = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(bank) for _ in range(25)]
    rows, i = [], 0
    while len(rows) < n:
        base = [rnd.choice(bank) for _ in range(rnd.choice([9, 12, 30, base_words, 150]))]
        if rnd.random() < 0.5:
            base[3:3] = passage
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(bank)
            rows.append((i, " ".join(w) if i % 3 else "  ".join(w).upper()))
            i += 1
            if rnd.random() < 0.3:
                base = w
    return rows[:n]


@pytest.mark.parametrize("seed,args", [(1, {}), (2, {"block_rows": 3, "slots": 64}), (3, {"percent": 70, "block_rows": 8, "slots": 1024})])
def test_components_by_all_pairs(spark, seed, args):
    rows = near_copies(random.Random(seed), 350)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = expected(rows, percent=args.get("percent", 90))
    assert got(frame, **args) == want
    assert 20 < len({c for _, _, c in want}) < 330


def test_op12_by_brute_force(spark, documents):
    found = sorted((tuple(r) for r in op12_jaccard_join(spark, SF_SMALL).collect()), key=str)
    assert found == expected([(d["doc_id"], d["text"]) for d in documents])


def test_odd_rows(spark, odd, empty):
    assert got(odd) == expected([(r[0], r[1]) for r in ROWS])
    assert jaccard_components(empty).count() == 0


def test_needed_is_the_least_overlap():
    for n in range(1, 60):
        for m in range(1, 60):
            least = next((c for c in range(min(n, m) + 1) if 100 * c >= 90 * (n + m - c)), 10 ** 6)
            assert least == 10 ** 6 and needed(n, m, 90) > min(n, m) or least == int(needed(np.int64(n), np.int64(m), 90))


def test_hub_is_split(spark):
    """A hub's edges fall into parts that do not grow with it."""
    edges = spark.range(1, 20_001).selectExpr("id AS a", "0L AS b")
    assert {r["root"] for r in connected_components(edges).collect()} == {0}
    flipped = edges.selectExpr("b AS a", "a AS b")
    salts = 64
    sizes = flipped.selectExpr("a", f"pmod(xxhash64(b), {salts}) AS s").groupBy("a", "s").count().collect()
    assert max(r["count"] for r in sizes) < 3 * 20_000 / salts
    assert _with_least(flipped, salts).selectExpr("min(m)", "max(m)").first()[0:2] == (1, 1)
