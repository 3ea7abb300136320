"""Message payloads (P8, K2, K4, K7) and the alert text.

All are projections of built-in expressions (``to_json``, ``format_number``,
plain double arithmetic), so they run in generated code on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.schemas import FLOW_FIELDS


def row_json(df: DataFrame, keep_nulls: bool = False) -> Column:
    """JSON text of the whole row. Spark drops NULL fields by default (the
    job's forwarders); ``keep_nulls`` writes them as ``null`` (the producer)."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts)


def forward_payload(df: DataFrame, key: str = "src_ip") -> DataFrame:
    """K2/K4: ``key`` is the source address (NULL allowed), ``value`` the row."""
    return df.select(F.col(key).cast("string").alias("key"), row_json(df).alias("value"))


# Fields a dataset's messages do not carry at all (UNSW has no SYN count).
ABSENT_FIELDS = {"unsw": ("syn_flag_count",)}


def publish_payload(raw: DataFrame, key: str = "src_ip", keep=()) -> DataFrame:
    """K7: raw message payload; a NULL or empty address is keyed ``unknown``.

    ``raw`` holds RAW_SCHEMA columns; ``keep`` names columns carried along.
    NULL fields are written as ``null``; a field the dataset does not have
    (``ABSENT_FIELDS``) is left out of its messages.
    """
    fields = FLOW_FIELDS + ["dataset_source", "produced_at_ts"]
    opts = {"ignoreNullFields": "false"}
    value = F.to_json(F.struct(*[F.col(c) for c in fields]), opts)
    for source, absent in ABSENT_FIELDS.items():
        narrow = F.to_json(F.struct(*[F.col(c) for c in fields if c not in absent]), opts)
        value = F.when(F.col("dataset_source") == source, narrow).otherwise(value)
    k = F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit("unknown"))
    return raw.select(k.alias("key"), value.alias("value"), *keep)


# The alert text, the fields in it and the defaults for absent ones.
ALERT_LAYOUT = (
    "\U0001f6a8 ALERT [%s] %s\n"
    "   src_ip       : %s\n"
    "   reason       : %s\n"
    "   event_count  : %s\n"
    "   syn_ratio    : %s\n"
    "   unique_ports : %s\n"
)
ALERT_FIELDS = ["dataset_source", "window_start", "src_ip", "alert_reason", "event_count", "syn_flag_ratio", "unique_dst_ports"]
ALERT_DEFAULTS = {
    "src_ip": "N/A",
    "alert_reason": "UNKNOWN",
    "event_count": 0,
    "syn_flag_ratio": 0.0,
    "dataset_source": "?",
    "window_start": "",
    "unique_dst_ports": 0,
}

# Alert message fields as the text formatter reads them from JSON.
ALERT_JSON_SCHEMA = (
    "src_ip STRING, alert_reason STRING, event_count BIGINT, syn_flag_ratio DOUBLE, "
    "dataset_source STRING, window_start STRING, unique_dst_ports BIGINT"
)


#: From here on a double is an integer, and three decimals of it are zeros.
WHOLE_FROM = 4503599627370496.0  # 2**52
BIGINT_UNTIL = 9223372036854774784.0  # the largest double below 2**63


def _inline(name: str, value: Column) -> Column:
    """An intermediate value as part of the expression that uses it."""
    return value


def python_fixed(x: Column, places: int = 3, bind=_inline) -> Column:
    """``x`` as text with ``places`` decimals, rounded the way Python's
    ``f"{x:.3f}"`` rounds: half-even on the exact binary value of the double.

    ``x * 10**places`` is rounded by the double product, so its exact error
    is recovered with Dekker's error-free product (split ``x`` in halves of
    26 bits); that error decides round-up, round-down and true ties exactly.
    From 2**52 on the number is an integer: written exactly as a bigint, and
    beyond that type by its decimal text (shortest digits, then zeros). The sign of a negative zero is kept.
    NaN and infinities print as ``nan`` and ``inf``.

    ``bind(name, value)`` may put an intermediate value, which later ones use
    many times, in a column of its own.
    """
    scale = float(10 ** places)
    a = bind("a", F.least(F.abs(x), F.lit(WHOLE_FROM)))
    p = bind("p", a * F.lit(scale))
    c = a * F.lit(134217729.0)  # 2**27 + 1 splits a into two 26-bit halves
    hi = bind("hi", c - (c - a))
    lo = a - hi
    err = bind("err", (hi * F.lit(scale) - p) + lo * F.lit(scale))  # a * scale == p + err exactly
    k0 = bind("k0", F.floor(p))
    k = bind("k", F.when((p == k0) & (err < 0), k0 - 1).otherwise(k0))
    d = bind("d", (p - (k + F.lit(0.5))) + err)
    # from 2**52 on the product is an integer and err holds what is left to round
    odd_half = (F.abs(err) == 0.5) & (k0 % 2 != 0)
    r = bind("r", (
        F.when(p >= F.lit(WHOLE_FROM), k0 + F.when(odd_half, F.signum(err)).otherwise(F.rint(err)).cast("bigint"))
        .when(d > 0, k + 1)
        .when(d < 0, k)
        .otherwise(F.when(k % 2 == 0, k).otherwise(k + 1))
    ).cast("bigint"))
    unit = int(scale)
    if places == 0:
        body = F.format_string("%d", r)
    else:
        body = F.format_string(f"%d.%0{places}d", F.call_function("div", r, F.lit(unit)), r % unit)
    zeros = F.lit("." + "0" * places if places else "")
    whole = F.concat(F.least(F.abs(x), F.lit(BIGINT_UNTIL)).cast("bigint").cast("string"), zeros)
    body = (F.when(F.abs(x) > F.lit(BIGINT_UNTIL), F.format_string(f"%.{places}f", F.abs(x)))
            .when(F.abs(x) >= F.lit(WHOLE_FROM), whole).otherwise(body))
    signed = F.when(x.cast("string").startswith("-"), F.concat(F.lit("-"), body)).otherwise(body)
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(x == F.lit(float("inf")), F.lit("inf"))
        .when(x == F.lit(float("-inf")), F.lit("-inf"))
        .otherwise(signed)
    )


def alert_text(alert: Column, bind=_inline) -> Column:
    """Six-line alert text from a parsed alert message struct.

    The event count gets thousands separators, the ratio three decimals
    rounded as Python rounds (``python_fixed``), the window start its first
    19 characters; absent fields take defaults.
    """
    values = {name: F.coalesce(alert.getField(name), F.lit(default)) for name, default in ALERT_DEFAULTS.items()}
    values["dataset_source"] = F.upper(values["dataset_source"])
    values["window_start"] = F.substring(values["window_start"], 1, 19)
    values["event_count"] = F.format_number(values["event_count"].cast("bigint"), 0)
    values["syn_flag_ratio"] = python_fixed(bind("ratio", values["syn_flag_ratio"]), 3, bind)
    return F.format_string(ALERT_LAYOUT, *[values[name] for name in ALERT_FIELDS])


def alert_text_from_json(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """J6's projection: alert JSON messages -> one ``alert_text`` per message.

    Messages are parsed, and the ratio is rounded, in projections of their own:
    what later steps use many times is not copied into them.
    """
    rows = messages.select(F.from_json(F.col(value_col).cast("string"), ALERT_JSON_SCHEMA).alias("alert")).select("alert.*")
    alert = F.struct(*[F.col(c) for c in rows.columns])

    def bind(name: str, value: Column) -> Column:
        nonlocal rows
        rows = rows.withColumn(f"__{name}", value)
        return F.col(f"__{name}")

    text = alert_text(alert, bind)
    return rows.select(text.alias("alert_text"))
