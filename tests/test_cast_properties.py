"""Property tests of the text helpers against independent models:
``safe_text`` against Python's ``float()``, ``to_long`` against a
character-by-character model of the non-ANSI integer parser."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.functions.sanitize import safe_text, to_double, to_long

ALPHABET = "0123456789+-._eEinfatyNIxXpPdD \t\x00\x7f\xa0 "
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=10), min_size=150, max_size=150)


def py_safe(v):
    """The producer's rule: text that float() reads as NaN or inf is dropped."""
    if v is None:
        return None
    try:
        f = float(v)
    except ValueError:
        return v
    return None if math.isnan(f) or math.isinf(f) else v


def legacy_long(v):
    """Model of the non-ANSI text -> bigint parser: blanks and control
    characters trimmed, optional sign, digits, an ignored fraction."""
    if v is None:
        return None
    b = v.encode("utf-8")

    def blank(x):
        return x <= 0x20 or x == 0x7F

    i, j = 0, len(b) - 1
    while i < len(b) and blank(b[i]):
        i += 1
    if i == len(b):
        return None
    while j > i and blank(b[j]):
        j -= 1
    neg = b[i] == ord("-")
    if neg or b[i] == ord("+"):
        if j == i:
            return None
        i += 1
    val = 0
    while i <= j:
        ch = b[i]
        i += 1
        if ch == ord("."):
            break
        if not 48 <= ch <= 57:
            return None
        val = val * 10 + (ch - 48)
    while i <= j:
        if not 48 <= b[i] <= 57:
            return None
        i += 1
    val = -val if neg else val
    return val if -(2 ** 63) <= val <= 2 ** 63 - 1 else None


def _apply(spark, fn, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    by_name = [r[0] for r in df.select(fn("v")).collect()]
    by_col = [r[0] for r in df.select(fn(F.col("v"))).collect()]
    assert [repr(x) for x in by_name] == [repr(x) for x in by_col]
    return by_name


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_safe_text_matches_python_float(spark, texts):
    texts = texts + ["1e400", "-1E999", "1_000e400", " nan ", "+Infinity", "1.5d", "infinityx"]
    got = _apply(spark, safe_text, texts)
    want = [py_safe(t) for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:5]


@settings(max_examples=6, deadline=None)
@given(TEXTS)
def test_to_long_matches_legacy_parser(spark, texts):
    texts = texts + [".", ".5", "+.", "-.", "-", "+", "", "80.9", "-3.7", " 80 ", "\x0012\x7f",
                     "9223372036854775807", "-9223372036854775808", "9223372036854775808",
                     "0x000b", "1e3", "1.2.3", "00012"]
    got = _apply(spark, to_long, texts)
    want = [legacy_long(t) for t in texts]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:5]


def test_to_double_cases(spark):
    cases = {
        "0x1p3": 8.0, "1.5d": 1.5, " 12 ": 12.0, "1e3": 1000.0, "-2.5E-1": -0.25, ".5": 0.5,
        "5.": 5.0, "\x0012": 12.0, ".": None, "1_0": None, "abc": None, "0x000b": None,
        "\xa012": None, "": None, "e5": None,
    }
    got = dict(zip(cases, _apply(spark, to_double, list(cases))))
    assert got == cases
    specials = ["Infinity", "-Infinity", "inf", "+INF", "-infinity", "NaN", "nan", "-nan", "+NaN"]
    vals = _apply(spark, to_double, specials)
    assert [math.isinf(v) and v > 0 for v in vals[:2]] == [True, False]
    assert math.isinf(vals[2]) and math.isinf(vals[3]) and vals[4] < 0
    assert all(math.isnan(v) for v in vals[5:])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=2 ** 62),
                          st.floats(min_value=0, max_value=5000, allow_nan=False)),
                min_size=100, max_size=100))
def test_alert_numbers_format_like_python(spark, pairs):
    """Event counts with thousands separators and ratios to three decimals,
    rounded as Python rounds the exact binary value (ties included)."""
    from flowlens.functions.payload import alert_text

    ties = [(k, m / 16) for k, m in enumerate(range(1, 64, 2))]
    near = [(7, 0.1235), (8, 2.675), (9, 0.0005), (10, 1.0005), (11, 999.9995)]
    pairs = pairs + ties + near
    df = spark.createDataFrame(pairs, "event_count long, syn_flag_ratio double")
    row = F.struct(
        F.lit(None).cast("string").alias("src_ip"), F.lit(None).cast("string").alias("alert_reason"),
        F.col("event_count"), F.col("syn_flag_ratio"),
        F.lit(None).cast("string").alias("dataset_source"),
        F.lit(None).cast("string").alias("window_start"),
        F.lit(None).cast("bigint").alias("unique_dst_ports"))
    got = [r.t for r in df.select(alert_text(row).alias("t")).collect()]
    for (n, r), text in zip(pairs, got):
        assert f"   event_count  : {n:,}\n" in text, (n, text)
        assert f"   syn_ratio    : {r:.3f}\n" in text, (r, text)
