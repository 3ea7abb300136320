"""Every registered query against its DuckDB SQL on sf0.001 (layer 3-6)."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare
from tests.conftest import SF_SMALL

_EXTRA = entry._llm()
QUERIES = {k: v for k, v in entry.queries().items() if _EXTRA is None or k not in _EXTRA.QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    problems, n = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert not problems, problems
    assert n > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "alert_reason" in df.columns
