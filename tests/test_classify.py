"""P10/P11 against the literal golden label table, and the SQL functions."""

from pyspark.sql import functions as F

from flowlens.functions.classify import classify_expr, register_sql_functions, severity_expr, with_category
from flowlens.plans.oracle import GOLDEN
from flowlens.sources.events_adapter import TEST_LABELS

# Extra rows beyond the fixture labels: (label, category, severity).
EXTRA = [
    (None, "Unknown", "Unknown"),
    ("\tbenign\n", "Benign", "Benign"),
    ("  ", "Other", "Unknown"),
    ("DrDoS_LDAP", "DDoS", "Critical"),
    ("udplag", "DDoS_UDPLag", "Critical"),
    ("Web Attack – Sql Injection", "Web_Attack_SQLi", "High"),
    ("Web Attack - Something", "Web_Attack", "High"),
    ("DoS GoldenEye", "DoS", "High"),
    ("botnet", "Botnet", "High"),
    (" 1 ", "Attack", "Unknown"),
    ("Exploits ", "Exploits", "High"),
]


def _rows():
    return [(lbl, c, s) for lbl, (c, s) in zip(TEST_LABELS, GOLDEN)] + EXTRA


def test_golden_labels(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "label string, cat string, sev string")
    got = df.select(
        "label", "cat", "sev",
        classify_expr("label").alias("c"),
    ).withColumn("s", severity_expr("c")).collect()
    bad = [(r.label, r.cat, r.c, r.sev, r.s) for r in got if (r.cat, r.sev) != (r.c, r.s)]
    assert not bad, bad


def test_sql_functions(spark):
    register_sql_functions(spark)
    rows = _rows()
    df = spark.createDataFrame(rows, "label string, cat string, sev string")
    df.createOrReplaceTempView("golden_labels")
    got = spark.sql(
        "SELECT label, cat, sev, classify_label(label) AS c, severity_of(classify_label(label)) AS s "
        "FROM golden_labels"
    ).collect()
    bad = [(r.label, r.c, r.s) for r in got if (r.cat, r.sev) != (r.c, r.s)]
    assert not bad, bad
    plan = spark.sql("SELECT severity_of(classify_label(label)) FROM golden_labels") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_severity_of_free_text(spark):
    df = spark.createDataFrame([("x-ddos-y",), ("",), ("generic",), ("credential stuff",)], "c string")
    got = [r.s for r in df.select(severity_expr("c").alias("s")).collect()]
    assert got == ["Critical", "Unknown", "Low", "High"]


def test_classify_stays_in_codegen(spark):
    df = spark.range(10).select(F.lit("DDoS").alias("label")).select(classify_expr("label").alias("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rules_compile_to_the_same_decisions(spark):
    """The CASE expressions (the SQL text and the looked-up form) decide every label
    as a plain evaluation of the rule tables does, on random labels built
    from the rule words."""
    import random

    from tests import rule_model

    words = ["ddos", "DrDoS", "syn", "UDP", "lag", "LDAP", "Web Attack", "web_attack", "brute",
             "XSS", "sql", "dos", "PortScan", "bot", "patator", "0", "1", "benign", "normal",
             "Generic", "worms", "x", "-", " ", "\t", "　", "\xa0"]
    rng = random.Random(7)
    labels = ["".join(rng.choice(words) for _ in range(rng.randint(0, 3))) for _ in range(600)]
    labels += [None, "", " ", " Syn ", "UDP-lag", "udplag"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    got = with_category(df, category="b", severity="t").select(
        "label", "b", "t", classify_expr("label").alias("a"),
    ).withColumn("s", severity_expr("a")).collect()
    for r in got:
        want = rule_model.category(r.label)
        assert r.a == want and r.b == want, (r.label, r.a, r.b, want)
        assert r.s == r.t == rule_model.severity(want), (r.label, r.s, r.t)


def test_filters_do_not_run_the_rules_again(spark):
    """A filter on the category neither copies the rules nor the key."""
    labels = spark.range(10).select(F.concat(F.lit("DoS "), F.col("id")).alias("label"))
    df = with_category(labels).filter("attack_category = 'Benign'")
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)
    assert plan.count("upper(") == 1 and plan.count("PORTMAP") == 1, plan
