"""The driver's ``events`` table seen as flow messages.

The test tables hold no network flows, so every query reads ``events``
through one deterministic projection: a narrow map, no shuffle, so it
costs one scan of ``events`` whatever its size. The same projection
is written in DuckDB SQL in ``flowlens.plans.oracle`` for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import default_parallelism

# The 45 test labels, in order (index = event_id % 45).
TEST_LABELS = [
    "BENIGN", "normal", "0", "1", "", " ", "DDoS", "DrDoS_DNS", "DrDoS_UDP", "WebDDoS",
    "Syn", "UDP", "UDPLag", "UDP-lag", "LDAP", "MSSQL", "NetBIOS", "NTP", "SNMP", "SSDP",
    "TFTP", "DNS", "Portmap", "DoS Hulk", "DoS slowloris", "Web Attack - Brute Force",
    "Web Attack - XSS", "Web Attack - Sql Injection", "WEB_ATTACK", "PortScan",
    "Reconnaissance", "Bot", "Infiltration", "FTP-Patator", "SSH-Patator", "Heartbleed",
    "Exploits", "Backdoor", "Backdoors", " Shellcode ", "Worms", " Fuzzers", "Generic",
    "Analysis", "Mystery",
]

# Junk cells of the dirty variant, chosen by (event_id + field) % 17.
JUNK_CELLS = ["", " ", "NaN", "Infinity", "-", "0x000b"]


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as it lies: one scan, one task a file split.

    A session may set ``flowlens.events.partitions`` to deal the rows out by
    their id first (the bench does, as the table is one row group); the plan
    depends on that setting alone.
    """
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    partitions = spark.conf.get("flowlens.events.partitions", None)
    return events.repartition(int(partitions), "event_id") if partitions else events


def dealt_out(events: DataFrame) -> DataFrame:
    """``events`` dealt out by their id, a part a core, for steps whose rows cost
    far more than a shuffle of them: a scan has no more tasks than the table has
    row groups, and a table of any size may be one. Rows of a part stay in the
    order of their ids: later sorts by time or window are cheap on such rows."""
    if events.sparkSession.conf.get("flowlens.events.partitions", None):
        return events  # dealt out already
    return events.repartition(default_parallelism(events.sparkSession), "event_id").sortWithinPartitions("event_id")


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


SOURCE_SQL = ("CASE WHEN event_type IN ('click', 'view') THEN 'cicids' "
              "WHEN event_type = 'error' THEN 'cicdos' ELSE 'unsw' END")


def _flow_sql() -> dict:
    """Typed flow columns as Spark SQL over an ``events`` row, by field."""
    k = "get_json_object(props, '$.k')"
    labels = "array(" + ", ".join(_lit(x) for x in TEST_LABELS) + ")"
    return {
        "src_ip": ("CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING) ELSE concat('10.0.', "
                   "CAST(CAST(floor(user_id / 256) AS BIGINT) AS STRING), '.', "
                   "CAST(user_id % 256 AS STRING)) END"),
        "dst_ip": f"concat('192.168.0.', {k})",
        "src_port": "CAST(1024 + event_id % 50000 AS BIGINT)",
        "dst_port": f"CAST({k} AS BIGINT)",
        "protocol": "CASE WHEN event_id % 3 = 0 THEN '6' WHEN event_id % 3 = 1 THEN '17' ELSE '0' END",
        "flow_duration": "value * 1000",
        "total_fwd_packets": "CAST(event_id % 11 AS BIGINT)",
        "total_bwd_packets": "CAST(event_id % 7 AS BIGINT)",
        "flow_bytes_s": "CASE WHEN event_id % 101 = 0 THEN CAST(NULL AS DOUBLE) ELSE value END",
        "flow_packets_s": "value / 10",
        "syn_flag_count": ("CASE WHEN event_type IN ('click', 'view', 'error') "
                           "THEN CAST(event_id % 3 AS BIGINT) END"),
        "label": f"element_at({labels}, CAST(event_id % {len(TEST_LABELS)} AS INT) + 1)",
    }


def _flow_columns() -> dict:
    """Typed flow columns, keyed by field name."""
    return {n: F.expr(e) for n, e in _flow_sql().items()}


def raw_flows(events: DataFrame, with_event_time: bool = True, keep=()) -> DataFrame:
    """``events`` as raw messages: RAW_SCHEMA columns, every flow field as
    text, ``produced_at_ts`` from the event time, plus ``event_time``."""
    cols = _flow_columns()
    ts = F.col("ts").cast("timestamp")
    out = [c.cast("string").alias(n) for n, c in cols.items()]
    out += [F.expr(SOURCE_SQL).alias("dataset_source"), F.unix_millis(ts).alias("produced_at_ts")]
    if with_event_time:
        out.append(ts.alias("event_time"))
    return events.select(*out, *keep)


# The dense variant: five minutes of traffic on each of five days (half of all
# events on the first), five addresses of which one is hot, and a SYN flood in
# one dataset, so that windows hold many rows and all default alerts occur.
DENSE_FLOWS = {
    "src_ip": ("CASE WHEN event_id % 97 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 5 < 3 THEN '10.0.0.1' "
               "ELSE concat('10.0.1.', CAST(user_id % 3 AS STRING)) END"),
    "syn_flag_count": ("CASE WHEN event_type = 'error' THEN CAST(event_id % 11 + 1 AS BIGINT) "
                       "WHEN event_type IN ('click', 'view') THEN CAST(event_id % 3 AS BIGINT) END"),
}
DENSE_TIME = ("timestamp_micros(1704067200000000 + 86400000000 * (CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 + user_id % 4 END) "
              "+ (unix_micros(CAST(ts AS TIMESTAMP)) % 86400000000) div 288)")


def dense_raw_flows(events: DataFrame) -> DataFrame:
    """``events`` as raw messages of the dense variant, with ``event_time``."""
    dense = {n: F.expr(e).cast("string") for n, e in DENSE_FLOWS.items()}
    out = [dense.get(n, c.cast("string")).alias(n) for n, c in _flow_columns().items()]
    return events.select(*out, F.expr(SOURCE_SQL).alias("dataset_source"), F.unix_millis(F.col("ts").cast("timestamp")).alias("produced_at_ts"),
                         F.expr(DENSE_TIME).alias("event_time"))


_INT_FIELDS = ("src_port", "dst_port", "total_fwd_packets", "total_bwd_packets", "syn_flag_count")


def dirty_raw_flows(events: DataFrame) -> DataFrame:
    """Raw messages with junk cells, padded and decimal integers, for the
    clean-up and cast path (P3, P4, P12).

    Cell ``i`` of a row is replaced when ``(event_id + i) % 17`` is below 8:
    0-5 pick a junk cell, 6 pads with spaces, 7 appends ``.9`` to integers.
    The label column is the UNSW ``attack_cat``; ``binary_label`` is the
    0/1 column used when it is empty.
    """
    base = raw_flows(events, keep=[F.col("event_id")])
    eid = F.col("event_id")
    junk = F.array(*[F.lit(j) for j in JUNK_CELLS])
    out = []
    for i, name in enumerate(_flow_columns().keys()):
        cell = F.col(name)
        if name == "label":
            out.append(cell)
            continue
        r = (eid + i) % 17
        expr = F.when(r < len(JUNK_CELLS), F.element_at(junk, (r + 1).cast("int")))
        expr = expr.when((r == 6) & cell.isNotNull(), F.concat(F.lit(" "), cell, F.lit(" ")))
        if name in _INT_FIELDS:
            expr = expr.when((r == 7) & cell.isNotNull(), F.concat(cell, F.lit(".9")))
        out.append(expr.otherwise(cell).alias(name))
    return base.select(
        "event_id", *out, "dataset_source", "produced_at_ts", "event_time",
        (eid % 2).cast("string").alias("binary_label"),
    )
