import pytest

from tests.conftest import SF_SMALL


@pytest.fixture(scope="session")
def documents(spark):
    """The (doc_id, text, lang, source, n_chars) rows of the smallest tables."""
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


#: Nulls in any column, empty texts, texts without words, ties, repeated rows
#: and one very long text; ``score``, ``n_lines`` and ``range`` clash with names that operators use.
LONG = "A common line that several documents of this small table share."
ROWS = [
    (None, None, None, None), (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, LONG, "en", "a"),
    (5, LONG, "en", "a"), (5, LONG, "en", "a"), (6, f"{LONG}\nother words here", "fr", "b"), (7, f"  {LONG.upper()} \nmore", "fr", "b"),
    (8, f"{LONG}\n{LONG}\nlast", "de", "b"), (9, "one", "de", "c"), (10, "one two", None, "c"),
    (11, "word " * 30_000 + "the end", "en", "a"), (None, "one", "en", "a"), (12, "Mail a.b@c.example.com or +1 (743) 555-3824 now", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, 1.5, "x", 7, True) for r in ROWS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double, n_lines string, range bigint, flagged boolean")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
