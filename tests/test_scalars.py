"""Scalar edges: P3, P4, P12, P16, P18/P19 (three-valued) and P22."""

import pytest
from pyspark.sql import functions as F

from flowlens.functions.payload import alert_text
from flowlens.functions.sanitize import label_fallback, safe_text, to_double, to_long
from flowlens.operators.windows import alert_flags, syn_flag_ratio


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize("text,kept", [
    ("Infinity", False), ("NaN", False), (" -inf ", False), ("1e400", False), ("-Infinity", False),
    ("nan", False), ("", True), (" ", True), ("abc", True), ("12.5", True), ("1e300", True),
    ("0x000b", True), ("-", True),
])
def test_safe_text(spark, text, kept):
    assert _one(spark, safe_text, text) == (text if kept else None)


@pytest.mark.parametrize("text,expected", [
    ("80", 80), ("80.0", 80), ("80.9", 80), (" 80 ", 80), ("", None), ("-", None),
    ("0x000b", None), ("-3.7", -3), ("9223372036854775807", 9223372036854775807),
    ("9223372036854775808", None), ("1e3", None), ("abc", None), ("+7", 7), (None, None),
])
def test_to_long(spark, text, expected):
    assert _one(spark, to_long, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("12.5", 12.5), (" 3 ", 3.0), ("1e3", 1000.0), (".5", 0.5), ("abc", None), ("", None),
    ("0x000b", None), ("-", None),
])
def test_to_double(spark, text, expected):
    assert _one(spark, to_double, text) == expected


def test_to_double_specials(spark):
    import math

    assert math.isinf(_one(spark, to_double, "Infinity"))
    assert math.isnan(_one(spark, to_double, "NaN"))


def test_label_fallback(spark):
    df = spark.createDataFrame(
        [("Exploits", "1"), ("", "0"), (None, "1"), (" ", "0")], "a string, b string")
    got = [r.o for r in df.select(label_fallback("a", "b").alias("o")).collect()]
    assert got == ["Exploits", "0", "1", " "]


def test_syn_ratio_and_alerts(spark):
    rows = [
        # event_count, syn, fwd
        (600, 10, 100),    # volume only
        (10, 90, 100),     # syn only
        (600, 90, 100),    # both
        (10, 10, 100),     # neither -> false
        (10, None, 100),   # unsw, packets: ratio NULL -> is_alert NULL
        (600, None, 100),  # unsw over volume -> true
        (10, None, 0),     # no packets -> ratio 0.0 -> false
    ]
    df = spark.createDataFrame(rows, "event_count long, syn long, fwd long")
    df = df.withColumn("syn_flag_ratio", syn_flag_ratio(F.col("syn"), F.col("fwd")))
    is_alert, reason = alert_flags(500, 0.8)
    got = [(r.syn_flag_ratio, r.a, r.r) for r in df.select("syn_flag_ratio", is_alert.alias("a"),
                                                            reason.alias("r")).collect()]
    assert got == [
        (0.1, True, "HIGH_VOLUME"),
        (0.9, True, "SYN_FLOOD"),
        (0.9, True, "HIGH_VOLUME+SYN_FLOOD"),
        (0.1, False, None),
        (None, None, None),
        (None, True, "HIGH_VOLUME"),
        (0.0, False, None),
    ]


def test_alert_text_format(spark):
    schema = ("src_ip string, alert_reason string, event_count long, syn_flag_ratio double, "
              "dataset_source string, window_start string, unique_dst_ports long")
    rows = [
        ("10.0.0.1", "HIGH_VOLUME", 1234567, 0.0625, "cicids", "2024-01-01T00:05:00.000Z", 12),
        (None, None, None, None, None, None, None),
        ("10.0.0.2", "SYN_FLOOD", 3, 0.1235, "unsw", "2024-01-02T10:00:00.000Z", 1),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r.t for r in df.select(alert_text(F.struct(*df.columns)).alias("t")).collect()]
    assert got[0] == (
        "\U0001f6a8 ALERT [CICIDS] 2024-01-01T00:05:00\n"
        "   src_ip       : 10.0.0.1\n"
        "   reason       : HIGH_VOLUME\n"
        "   event_count  : 1,234,567\n"
        "   syn_ratio    : 0.062\n"
        "   unique_ports : 12\n"
    )
    assert got[1] == (
        "\U0001f6a8 ALERT [?] \n   src_ip       : N/A\n   reason       : UNKNOWN\n"
        "   event_count  : 0\n   syn_ratio    : 0.000\n   unique_ports : 0\n"
    )
    # Python rounds the exact binary value: 0.1235 is just below the tie
    assert "   syn_ratio    : 0.123\n" in got[2]


def test_name_and_column_forms_agree(spark):
    """The SQL-text form (column name) and the Column form are the same rules."""
    from flowlens.sources.events_adapter import JUNK_CELLS, TEST_LABELS

    cells = TEST_LABELS + JUNK_CELLS + [" 80 ", "80.9", "-3.7", "1e400", "1e3", "+inf", None]
    df = spark.createDataFrame([(c,) for c in cells], "v string")
    pairs = [(to_long, "bigint"), (to_double, "double"), (safe_text, "string")]
    for fn, _ in pairs:
        a = [r[0] for r in df.select(fn("v")).collect()]
        b = [r[0] for r in df.select(fn(F.col("v"))).collect()]
        assert [str(x) for x in a] == [str(x) for x in b], fn.__name__


@pytest.mark.parametrize("value", [0.0625, -0.0625, -0.0001, 2.675, 1e-9, 123456.7895, 0.5, 1.5,
                                   2.5, float("nan"), float("inf"), float("-inf"), 0.0, -0.0,
                                   9.3e15, -9.3e15, 2.0 ** 60, 4503599627370495.5, 4503599627370496.0, 1e22])
@pytest.mark.parametrize("places", [0, 2, 3])
def test_python_fixed(spark, value, places):
    from flowlens.functions.payload import python_fixed

    got = spark.createDataFrame([(value,)], "v double").select(
        python_fixed(F.col("v"), places).alias("t")).first().t
    assert got == f"{value:.{places}f}"
