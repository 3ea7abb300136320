"""Cell clean-up and numeric casts.

Raw cells are text. ``safe_text`` turns text that reads as NaN or an
infinity into NULL and keeps everything else; the casts turn text into
numbers the way a non-ANSI cast does and give NULL for anything else, so
one bad cell never fails a job.

Every cast is guarded by a pattern test: only text of the right shape
reaches the cast, because a cast that fails costs far more than the test
(it raises and catches an exception per cell).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the casts trim: the integer parser drops ASCII blanks and
# control characters (0x00-0x20, 0x7f); the number parser drops 0x00-0x20.
LONG_PAD = "".join(chr(i) for i in range(0x21)) + "\x7f"
DOUBLE_PAD = "".join(chr(i) for i in range(0x21))
# Characters Python strips around a float (``str.isspace``), by rule.
_PY_SPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Text shapes (matched after trimming).
# Integer text of the non-ANSI cast: sign, digits, an ignored fraction.
LONG_SHAPE = r"^[+-]?(?=[0-9.])[0-9]*([.][0-9]*)?$"
LONG_DIGITS = r"^[+-]?([0-9]*)"
# What nearly all integer cells look like; always in the bigint range.
LONG_PLAIN = "^[0-9]{1,18}$"
# Number text the double cast reads (decimal or hexadecimal, f/d suffix).
DOUBLE_SHAPE = (r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
                r"|0[xX]([0-9a-fA-F]+[.]?[0-9a-fA-F]*|[.][0-9a-fA-F]+)[pP][+-]?[0-9]+)[dDfF]?$")
# Named values of the double cast, by their lower-case text.
DOUBLE_WORDS = {
    "inf": "Infinity", "+inf": "Infinity", "infinity": "Infinity", "+infinity": "Infinity",
    "-inf": "-Infinity", "-infinity": "-Infinity", "nan": "NaN", "+nan": "NaN", "-nan": "NaN",
}
# Python float text: digits with single underscores between them.
_PY_DIGITS = r"[0-9](?:_?[0-9])*"
PY_FLOAT_SHAPE = (rf"^[+-]?(?:(?:{_PY_DIGITS})?[.]{_PY_DIGITS}|{_PY_DIGITS}[.]?)"
                  rf"(?:[eE][+-]?{_PY_DIGITS})?$")
SPECIAL_SHAPE = r"(?i)^[+-]?(nan|inf|infinity)$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_lit(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\u%04x" % ord(ch) if ch in "'\\" or not (" " <= ch <= "~") else ch)
    return "'" + "".join(out) + "'"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def trimmed_sql(c: str, pad: str = DOUBLE_PAD) -> str:
    """The cell without the characters a cast ignores around it."""
    return f"btrim({c}, {_sql_lit(pad)})"


def to_double_sql(c: str, trimmed: str | None = None) -> str:
    """Text to double as SQL (see ``to_double``); ``trimmed`` names an
    already computed ``trimmed_sql(c)``."""
    t = trimmed or trimmed_sql(c)
    words = " ".join(f"WHEN {_sql_lit(k)} THEN double({_sql_lit(v)})"
                     for k, v in DOUBLE_WORDS.items())
    return (f"CASE WHEN {t} RLIKE {_sql_lit(DOUBLE_SHAPE)} THEN try_cast({t} AS DOUBLE) "
            f"ELSE CASE lower({t}) {words} END END")


def to_long_sql(c: str, trimmed: str | None = None) -> str:
    """Text to bigint as SQL (see ``to_long``); ``trimmed`` names an already
    computed ``trimmed_sql(c, LONG_PAD)``."""
    t = trimmed or trimmed_sql(c, LONG_PAD)
    digits = f"regexp_extract({t}, {_sql_lit(LONG_DIGITS)}, 1)"
    sign = f"CASE WHEN startswith({t}, '-') THEN '-' ELSE '' END"
    number = f"concat({sign}, CASE WHEN {digits} = '' THEN '0' ELSE {digits} END)"
    return (f"CASE WHEN {t} RLIKE {_sql_lit(LONG_PLAIN)} THEN CAST({t} AS BIGINT) "
            f"WHEN {t} RLIKE {_sql_lit(LONG_SHAPE)} THEN try_cast({number} AS BIGINT) END")


def safe_text_sql(c: str) -> str:
    """NaN/infinity text to NULL as SQL (see ``safe_text``)."""
    t = f"btrim({c}, {_sql_lit(_PY_SPACE)})"
    number = f"try_cast(replace({t}, '_', '') AS DOUBLE)"
    overflow = f"({t} RLIKE {_sql_lit(PY_FLOAT_SHAPE)} AND abs({number}) = double('inf'))"
    # only text with an n (nan, inf), an exponent or over 300 characters can be one
    unusual = f"(contains(lower({c}), 'n') OR contains(lower({c}), 'e') OR length({c}) > 300)"
    return (f"CASE WHEN {unusual} AND ({t} RLIKE {_sql_lit(SPECIAL_SHAPE)} OR {overflow}) "
            f"THEN CAST(NULL AS STRING) ELSE {c} END")


def to_double(c) -> Column:
    """Text to double as the non-ANSI cast reads it: decimal or hexadecimal
    numbers (an f/d suffix allowed), ``NaN``/``Infinity`` and the words
    inf, infinity and nan (any case, signed); NULL for anything else.
    ``c`` is a column or its name."""
    if isinstance(c, str):
        return F.expr(to_double_sql(_quote(c)))
    t = F.btrim(c, F.lit(DOUBLE_PAD))
    words = F.lower(t)
    expr = F.when(t.rlike(DOUBLE_SHAPE), t.try_cast("double"))
    for k, v in DOUBLE_WORDS.items():
        expr = expr.when(words == k, F.lit(v).cast("double"))
    return expr


def to_long(c) -> Column:
    """Text to bigint as the non-ANSI cast reads it: ``' 80 '``, ``'80.0'``
    and ``'80.9'`` give 80, ``'-3.7'`` gives -3, ``'.5'`` gives 0; ``''``,
    ``'-'``, ``'0x000b'`` and ``'1e3'`` give NULL, as does a value beyond
    the bigint range."""
    if isinstance(c, str):
        return F.expr(to_long_sql(_quote(c)))
    t = F.btrim(c, F.lit(LONG_PAD))
    digits = F.regexp_extract(t, LONG_DIGITS, 1)
    number = F.concat(F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit("")),
                      F.when(digits == "", F.lit("0")).otherwise(digits))
    return F.when(t.rlike(LONG_PLAIN), t.cast("bigint")).when(t.rlike(LONG_SHAPE), number.try_cast("bigint"))


def safe_text(c) -> Column:
    """NULL when Python's ``float()`` would read the text as NaN or an
    infinity (overflow such as ``1e400`` included); every other text is
    kept as it is."""
    if isinstance(c, str):
        return F.expr(safe_text_sql(_quote(c)))
    t = F.btrim(c, F.lit(_PY_SPACE))
    number = F.replace(t, F.lit("_"), F.lit("")).try_cast("double")
    overflow = t.rlike(PY_FLOAT_SHAPE) & (F.abs(number) == F.lit(float("inf")))
    low = F.lower(c)
    unusual = low.contains("n") | low.contains("e") | (F.length(c) > 300)
    return F.when(unusual & (t.rlike(SPECIAL_SHAPE) | overflow), F.lit(None).cast("string")).otherwise(c)


def label_fallback(attack_cat, binary_label) -> Column:
    """UNSW label: ``attack_cat`` unless it is NULL or empty, else the 0/1 label."""
    a = _as_col(attack_cat)
    return F.when(a.isNull() | (a == ""), _as_col(binary_label)).otherwise(a)


def stable_round(c, places: int = 4) -> Column:
    """Round a double through decimal(38,9), so engines that sum in another
    order still print the same value."""
    return F.round(_as_col(c).cast("decimal(38,9)"), places).cast("double")
