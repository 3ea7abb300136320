"""Label -> attack category -> severity, as native Catalyst expressions.

The rules are one ``CASE`` over a label's key; there is no Python in the
per-row path, and no form computes the key more than once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters a label is stripped of before the rules: the characters
# Python's ``str.strip`` removes (``str.isspace``), derived by rule.
_BLANKS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


@dataclass(frozen=True)
class Rule:
    """One category rule: equals any of ``equals`` or contains any of
    ``contains`` (and every group in ``also``, and none of ``lacks``)."""

    category: str
    equals: tuple = ()
    contains: tuple = ()
    also: tuple = ()
    lacks: tuple = ()


_WEB = ("WEB ATTACK", "WEB_ATTACK")

# Category rules in the order they are tried; first match wins.
CATEGORY_RULES = [
    Rule("Benign", equals=("BENIGN", "0", "NORMAL")),
    Rule("DDoS", contains=("DDOS", "DRDOS")),
    Rule("DDoS_SYN", equals=("SYN",)),
    Rule("DDoS_UDP", contains=("UDP",), lacks=("LAG",)),
    Rule("DDoS_UDPLag", contains=("UDPLAG",)),
    Rule("DDoS_LDAP", contains=("LDAP",)),
    Rule("DDoS_MSSQL", contains=("MSSQL",)),
    Rule("DDoS_NetBIOS", contains=("NETBIOS",)),
    Rule("DDoS_NTP", contains=("NTP",)),
    Rule("DDoS_SNMP", contains=("SNMP",)),
    Rule("DDoS_SSDP", contains=("SSDP",)),
    Rule("DDoS_TFTP", contains=("TFTP",)),
    Rule("DDoS_DNS", contains=("DNS",)),
    Rule("DDoS_Portmap", contains=("PORTMAP",)),
    Rule("DoS", contains=("DOS",)),
    Rule("Web_Attack_BruteForce", contains=_WEB, also=(("BRUTE",),)),
    Rule("Web_Attack_XSS", contains=_WEB, also=(("XSS",),)),
    Rule("Web_Attack_SQLi", contains=_WEB, also=(("SQL",),)),
    Rule("Web_Attack", contains=_WEB),
    Rule("Reconnaissance", contains=("PORTSCAN", "RECONNAISSANCE")),
    Rule("Botnet", contains=("BOT",)),
    Rule("Infiltration", contains=("INFILTRATION",)),
    Rule("Credential_Attack", contains=("PATATOR",)),
    Rule("Exploits", contains=("HEARTBLEED", "EXPLOITS")),
    Rule("Backdoor", contains=("BACKDOOR",)),
    Rule("Shellcode", contains=("SHELLCODE",)),
    Rule("Worms", contains=("WORMS",)),
    Rule("Fuzzers", contains=("FUZZERS",)),
    Rule("Generic", contains=("GENERIC",)),
    Rule("Analysis", contains=("ANALYSIS",)),
    Rule("Attack", equals=("1",)),
]
CATEGORY_EMPTY = "Unknown"
CATEGORY_DEFAULT = "Other"

# Severity by keyword in the upper-cased category, in order.
SEVERITY_RULES = [
    ("Critical", ("DDOS", "SYN", "MSSQL", "NETBIOS", "NTP", "SNMP", "SSDP", "TFTP",
                  "DNS", "PORTMAP", "LDAP")),
    ("High", ("EXPLOITS", "SHELLCODE", "BACKDOOR", "WORMS", "BOTNET")),
    ("High", ("WEB_ATTACK", "CREDENTIAL", "DOS")),
    ("Medium", ("RECONNAISSANCE", "INFILTRATION", "FUZZERS", "ANALYSIS")),
    ("Low", ("GENERIC",)),
]
SEVERITY_BENIGN = ("BENIGN", "Benign")
SEVERITY_DEFAULT = "Unknown"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_str(s: str) -> str:
    out = []
    for ch in s:
        if ch == "'" or ch == "\\" or not (" " <= ch <= "~"):
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def _sql_any(u: str, tokens) -> str:
    return "(" + " OR ".join(f"contains({u}, {_sql_str(t)})" for t in tokens) + ")"


def _condition_sql(u: str, rule: Rule) -> str:
    """The rule's test of the key ``u``."""
    if rule.equals:
        return f"{u} IN (" + ", ".join(_sql_str(t) for t in rule.equals) + ")"
    cond = _sql_any(u, rule.contains)
    for group in rule.also:
        cond += " AND " + _sql_any(u, group)
    for t in rule.lacks:
        cond += f" AND NOT contains({u}, {_sql_str(t)})"
    return cond


def _case_sql(label: str, key: str, values: list[str]) -> str:
    """P10 as a ``CASE`` over the SQL expressions of a label and its key;
    ``values`` are the results: empty label, each rule in order, no rule."""
    whens = [f"WHEN {_condition_sql(key, r)} THEN {v}" for r, v in zip(CATEGORY_RULES, values[1:-1], strict=True)]
    return f"CASE WHEN {label} IS NULL OR {label} = '' THEN {values[0]} {' '.join(whens)} ELSE {values[-1]} END"


#: Results of P10 by rule number: 0 for an empty label, then the rules, then no rule.
CATEGORIES = [CATEGORY_EMPTY, *[r.category for r in CATEGORY_RULES], CATEGORY_DEFAULT]


def label_key_sql(label: str) -> str:
    """The trimmed, upper-cased label the category rules test."""
    return f"upper(btrim({label}, {_sql_str(_BLANKS)}))"


def classify_sql(label: str) -> str:
    """P10 as SQL text over the SQL expression ``label``.

    The key is bound once, as the only element of an array that ``transform``
    runs the rules over, so no rule computes it again, wherever the optimiser
    moves the expression.
    """
    rules = _case_sql(label, "k", [_sql_str(c) for c in CATEGORIES])
    return f"element_at(transform(array({label_key_sql(label)}), k -> {rules}), 1)"


def severity_sql(category: str) -> str:
    """P11 as SQL text over the SQL expression ``category``; the upper-cased
    category is bound once (see ``classify_sql``)."""
    parts = [f"CASE WHEN {category} IS NULL OR {category} = '' THEN {_sql_str(SEVERITY_DEFAULT)}",
             f"WHEN c = {_sql_str(SEVERITY_BENIGN[0])} THEN {_sql_str(SEVERITY_BENIGN[1])}"]
    parts += [f"WHEN {_sql_any('c', tokens)} THEN {_sql_str(level)}" for level, tokens in SEVERITY_RULES]
    parts.append(f"ELSE {_sql_str(SEVERITY_DEFAULT)} END")
    return f"element_at(transform(array(upper({category})), c -> {' '.join(parts)}), 1)"


def classify_expr(label: str) -> Column:
    """Attack category (P10) of the column named ``label``."""
    return F.expr(classify_sql(_quote(label)))


def severity_expr(category: str) -> Column:
    """Severity level (P11) of the column named ``category``."""
    return F.expr(severity_sql(_quote(category)))


def category_severity(category: str) -> str:
    """P11 of one category, for the table that ``with_category`` looks up."""
    if not category:
        return SEVERITY_DEFAULT
    key = category.upper()
    if key == SEVERITY_BENIGN[0]:
        return SEVERITY_BENIGN[1]
    return next((level for level, tokens in SEVERITY_RULES if any(t in key for t in tokens)), SEVERITY_DEFAULT)


def with_category(df: DataFrame, label: str = "label", category: str = "attack_category",
                  severity: str | None = "severity_level") -> DataFrame:
    """Add the category (and severity) columns to ``df``.

    The rules run once a row and give a rule number, from which category and
    severity are looked up. The number comes out of an ``explode`` of one
    element: a filter or projection on the category, which the optimiser
    copies the look-up into, cannot be moved below it, so it never runs the
    rules a second time.
    """
    key, rule = "__label_key", "__rule"
    numbers = [str(i + 1) for i in range(len(CATEGORIES))]
    out = df.withColumn(key, F.expr(label_key_sql(_quote(label))))
    out = out.withColumn(rule, F.explode(F.array(F.expr(_case_sql(_quote(label), _quote(key), numbers)))))

    def look_up(values: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(rule))

    out = out.withColumn(category, look_up(CATEGORIES))
    if severity:
        out = out.withColumn(severity, look_up([category_severity(c) for c in CATEGORIES]))
    return out.drop(key, rule)


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the two mappings to SQL as ``classify_label(label)`` and
    ``severity_of(category)`` (U1, U2): SQL functions over the same rules."""
    for name, argument, body in (("classify_label", "label", classify_sql("label")), ("severity_of", "category", severity_sql("category"))):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument} STRING) RETURNS STRING RETURN {body}")
