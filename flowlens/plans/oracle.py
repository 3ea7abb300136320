"""DuckDB SQL for the correctness checks.

The flows are written a second time here, independently of the Spark
code: categories and severities come from the golden label table of the
test fixture (not from the rule list), casts are spelled out for DuckDB.
Doubles are compared after ``round(cast(x as decimal(38,9)), 4)``.
"""

from __future__ import annotations

from flowlens.plans.layout import layout_columns
from flowlens.sources.events_adapter import JUNK_CELLS, TEST_LABELS

AS_OF = "2024-01-30"

# Golden table of the test labels -> (category, severity), in
# label order; reviewed by hand against the rules.
GOLDEN = [
    ("Benign", "Benign"), ("Benign", "Benign"), ("Benign", "Benign"), ("Attack", "Unknown"),
    ("Unknown", "Unknown"), ("Other", "Unknown"), ("DDoS", "Critical"), ("DDoS", "Critical"),
    ("DDoS", "Critical"), ("DDoS", "Critical"), ("DDoS_SYN", "Critical"), ("DDoS_UDP", "Critical"),
    ("DDoS_UDPLag", "Critical"), ("Other", "Unknown"), ("DDoS_LDAP", "Critical"),
    ("DDoS_MSSQL", "Critical"), ("DDoS_NetBIOS", "Critical"), ("DDoS_NTP", "Critical"),
    ("DDoS_SNMP", "Critical"), ("DDoS_SSDP", "Critical"), ("DDoS_TFTP", "Critical"),
    ("DDoS_DNS", "Critical"), ("DDoS_Portmap", "Critical"), ("DoS", "High"), ("DoS", "High"),
    ("Web_Attack_BruteForce", "High"), ("Web_Attack_XSS", "High"), ("Web_Attack_SQLi", "High"),
    ("Web_Attack", "High"), ("Reconnaissance", "Medium"), ("Reconnaissance", "Medium"),
    ("Botnet", "High"), ("Infiltration", "Medium"), ("Credential_Attack", "High"),
    ("Credential_Attack", "High"), ("Exploits", "High"), ("Exploits", "High"),
    ("Backdoor", "High"), ("Backdoor", "High"), ("Shellcode", "High"), ("Worms", "High"),
    ("Fuzzers", "Medium"), ("Generic", "Low"), ("Analysis", "Medium"), ("Other", "Unknown"),
]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _golden_values() -> str:
    rows = [f"({i}, {_q(lbl)}, {_q(c)}, {_q(s)})"
            for i, (lbl, (c, s)) in enumerate(zip(TEST_LABELS, GOLDEN))]
    return "(VALUES " + ", ".join(rows) + ") AS g(idx, label, attack_category, severity_level)"


def R(x: str) -> str:
    """Stable rounding of a double expression."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,9)), 4) AS DOUBLE)"


SOURCE = ("CASE WHEN event_type IN ('click','view') THEN 'cicids' "
          "WHEN event_type = 'error' THEN 'cicdos' ELSE 'unsw' END")

# Typed flow columns of one events row (DuckDB dialect).
FLOW_COLS = {
    "src_ip": ("CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('10.0.', "
               "CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR), '.', "
               "CAST(user_id % 256 AS VARCHAR)) END"),
    "dst_ip": "concat('192.168.0.', json_extract_string(props, '$.k'))",
    "src_port": "CAST(1024 + event_id % 50000 AS BIGINT)",
    "dst_port": "CAST(json_extract_string(props, '$.k') AS BIGINT)",
    "protocol": "CASE event_id % 3 WHEN 0 THEN '6' WHEN 1 THEN '17' ELSE '0' END",
    "flow_duration": "value * 1000",
    "total_fwd_packets": "CAST(event_id % 11 AS BIGINT)",
    "total_bwd_packets": "CAST(event_id % 7 AS BIGINT)",
    "flow_bytes_s": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value END",
    "flow_packets_s": "value / 10",
    "syn_flag_count": ("CASE WHEN event_type IN ('click','view','error') "
                       "THEN CAST(event_id % 3 AS BIGINT) END"),
}

NORM_COLS = [
    "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "flow_duration",
    "total_fwd_packets", "total_bwd_packets", "flow_bytes_s", "flow_packets_s",
    "syn_flag_count", "label", "dataset_source", "produced_at_ts", "attack_category",
    "severity_level", "event_timestamp", "partition_date",
]


# The dense variant's own columns and time (DuckDB dialect).
DENSE_COLS = {
    "src_ip": ("CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 5 < 3 THEN '10.0.0.1' "
               "ELSE concat('10.0.1.', CAST(user_id % 3 AS VARCHAR)) END"),
    "syn_flag_count": ("CASE WHEN event_type = 'error' THEN CAST(event_id % 11 + 1 AS BIGINT) "
                       "WHEN event_type IN ('click','view') THEN CAST(event_id % 3 AS BIGINT) END"),
}
DENSE_TS = ("make_timestamp(1704067200000000 + 86400000000 * (CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 + user_id % 4 END) "
            "+ (epoch_us(e.ts) % 86400000000) // 288)")


def flows_cte(ts_expr: str = "e.ts", own: dict | None = None) -> str:
    """``flows``: the normalised rows of ``events``; ``own`` replaces columns."""
    cols = [f"{v} AS {k}" for k, v in (FLOW_COLS | (own or {})).items()]
    cols += [
        "g.label AS label",
        f"{SOURCE} AS dataset_source",
        "CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS produced_at_ts",
        "g.attack_category AS attack_category",
        "g.severity_level AS severity_level",
        f"CAST({ts_expr} AS TIMESTAMP) AS event_timestamp",
        f"strftime({ts_expr}, '%Y-%m-%d') AS partition_date",
        "e.event_id AS event_id",
    ]
    return ("flows AS (SELECT " + ", ".join(cols) + " FROM events e JOIN "
            + _golden_values() + " ON g.idx = CAST(e.event_id % 45 AS INT))")


def windows_cte(width: str, events_threshold: int, syn_threshold: float,
                src: str = "flows", name: str = "windows", key: str = "src_ip") -> str:
    """``windows``: the window table over ``src`` (DuckDB dialect)."""
    agg = (
        f"agg AS (SELECT time_bucket(INTERVAL '{width}', event_timestamp) AS window_start, "
        f"{key}, dataset_source, count(*) AS event_count, "
        "count(DISTINCT label) AS unique_labels, count(DISTINCT dst_port) AS unique_dst_ports, "
        "avg(flow_duration) AS avg_flow_duration, avg(flow_bytes_s) AS avg_flow_bytes_s, "
        "CAST(sum(syn_flag_count) AS BIGINT) AS total_syn_flags, "
        "CAST(sum(total_fwd_packets) AS BIGINT) AS total_fwd_packets "
        f"FROM {src} GROUP BY ALL)"
    )
    ratio = ("CASE WHEN total_fwd_packets > 0 THEN total_syn_flags / total_fwd_packets "
             "ELSE 0.0 END")
    vol = f"(event_count > {events_threshold})"
    syn = f"(syn_flag_ratio > {syn_threshold})"
    win = (
        f"{name} AS (SELECT *, {vol} OR {syn} AS is_alert, "
        f"CASE WHEN {vol} AND {syn} THEN 'HIGH_VOLUME+SYN_FLOOD' WHEN {vol} THEN 'HIGH_VOLUME' "
        f"WHEN {syn} THEN 'SYN_FLOOD' END AS alert_reason FROM (SELECT {key}, dataset_source, "
        "event_count, unique_labels, unique_dst_ports, avg_flow_duration, avg_flow_bytes_s, "
        f"total_syn_flags, total_fwd_packets, {ratio} AS syn_flag_ratio, window_start, "
        f"window_start + INTERVAL '{width}' AS window_end, "
        "strftime(window_start, '%Y-%m-%d') AS window_start_date FROM agg))"
    )
    return agg + ", " + win


WINDOW_OUT = (
    f"src_ip, dataset_source, event_count, unique_labels, unique_dst_ports, "
    f"{R('avg_flow_duration')} AS avg_flow_duration, {R('avg_flow_bytes_s')} AS avg_flow_bytes_s, "
    f"total_syn_flags, total_fwd_packets, {R('syn_flag_ratio')} AS syn_flag_ratio, "
    "window_start, window_end, window_start_date, is_alert, alert_reason"
)


def _since_yesterday(col: str, as_of: str = AS_OF) -> str:
    return f"{col} >= strftime(DATE '{as_of}' - INTERVAL 1 DAY, '%Y-%m-%d')"


def _long_text(v: str) -> str:
    """A non-ANSI text -> bigint cast: trims, truncates decimals, no hex."""
    t = f"trim({v})"
    return (f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS BIGINT) "
            f"WHEN regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN TRY_CAST(trunc(TRY_CAST({t} AS DECIMAL(38,10))) AS BIGINT) END")


def _double_text(v: str) -> str:
    t = f"trim({v})"
    return (f"CASE WHEN regexp_full_match(lower({t}), "
            f"'[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|nan|infinity|inf)') "
            f"THEN TRY_CAST({t} AS DOUBLE) END")


def _safe(v: str) -> str:
    d = _double_text(v)
    return f"CASE WHEN isnan({d}) OR isinf({d}) THEN NULL ELSE {v} END"


def dirty_cte() -> str:
    """``dirty``: raw text cells with junk, as ``dirty_raw_flows`` makes them."""
    junk = "[" + ", ".join(_q(j) for j in JUNK_CELLS) + "]"
    ints = {"src_port", "dst_port", "total_fwd_packets", "total_bwd_packets", "syn_flag_count"}
    cols = []
    for i, (name, expr) in enumerate(FLOW_COLS.items()):
        cell = f"CAST({expr} AS VARCHAR)"
        r = f"((event_id + {i}) % 17)"
        case = (f"CASE WHEN {r} < {len(JUNK_CELLS)} THEN {junk}[CAST({r} AS INT) + 1] "
                f"WHEN {r} = 6 AND {cell} IS NOT NULL THEN ' ' || {cell} || ' ' ")
        if name in ints:
            case += f"WHEN {r} = 7 AND {cell} IS NOT NULL THEN {cell} || '.9' "
        cols.append(case + f"ELSE {cell} END AS {name}")
    cols += [
        "g.label AS label", f"{SOURCE} AS dataset_source",
        "CAST(epoch_us(e.ts) // 1000 AS BIGINT) AS produced_at_ts",
        "CAST(e.ts AS TIMESTAMP) AS event_time", "CAST(event_id % 2 AS VARCHAR) AS binary_label",
        "event_id",
    ]
    return ("dirty AS (SELECT " + ", ".join(cols) + " FROM events e JOIN "
            + _golden_values() + " ON g.idx = CAST(e.event_id % 45 AS INT))")


def normalize_raw_sql() -> str:
    """Clean, fall back, cast and classify the dirty cells."""
    safe = {n: _safe(n) for n in list(FLOW_COLS) + ["label"]}
    label = (f"CASE WHEN dataset_source = 'unsw' AND ({safe['label']} IS NULL OR {safe['label']} = '') "
             f"THEN {_safe('binary_label')} ELSE {safe['label']} END")
    golden = ("CASE " + " ".join(f"WHEN l = {_q(lbl)} THEN {_q(c)}" for lbl, (c, _) in zip(TEST_LABELS, GOLDEN))
              + " WHEN l IS NULL OR l = '' THEN 'Unknown' WHEN trim(l) = '0' THEN 'Benign' "
              "WHEN trim(l) = '1' THEN 'Attack' ELSE NULL END")
    sev = ("CASE attack_category " + " ".join(
        f"WHEN {_q(c)} THEN {_q(s)}" for c, s in sorted(set(GOLDEN))) + " END")
    out = []
    for n in FLOW_COLS:
        if n in ("src_port", "dst_port", "total_fwd_packets", "total_bwd_packets", "syn_flag_count"):
            out.append(f"{_long_text(safe[n])} AS {n}")
        elif n in ("flow_duration", "flow_bytes_s", "flow_packets_s"):
            out.append(f"{R(_double_text(safe[n]))} AS {n}")
        else:
            out.append(f"{safe[n]} AS {n}")
    return (
        "WITH " + dirty_cte() + ", cleaned AS (SELECT " + ", ".join(out) + f", {label} AS l, "
        "dataset_source, produced_at_ts, event_time FROM dirty), "
        f"classed AS (SELECT *, {golden} AS attack_category FROM cleaned) "
        "SELECT src_ip, dst_ip, src_port, dst_port, protocol, flow_duration, total_fwd_packets, "
        "total_bwd_packets, flow_bytes_s, flow_packets_s, syn_flag_count, l AS label, "
        f"dataset_source, produced_at_ts, attack_category, {sev} AS severity_level, "
        "event_time AS event_timestamp, strftime(event_time, '%Y-%m-%d') AS partition_date "
        "FROM classed"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def batch_sql() -> dict:
    flows = flows_cte()
    day = windows_cte("1 day", 3, 0.8)
    five = windows_cte("5 minutes", 500, 0.8)
    dense = flows_cte(DENSE_TS, DENSE_COLS)
    recent = ("SELECT attack_category, severity_level, label, dataset_source, count(*) AS event_count "
              f"FROM flows WHERE {_since_yesterday('partition_date')} AND attack_category <> 'Benign' "
              "GROUP BY ALL")
    not_benign = "attack_category <> 'Benign'"
    return {
        "classify_severity": _with(flows) + (
            "SELECT label, attack_category, severity_level, dataset_source, produced_at_ts FROM flows"),
        "normalize_raw": normalize_raw_sql(),
        "attack_distribution": _with(flows) + (
            "SELECT attack_category, severity_level, dataset_source, count(*) AS event_count "
            "FROM flows GROUP BY ALL"),
        "hourly_timeseries": _with(flows) + (
            "SELECT date_trunc('hour', event_timestamp) AS hour_bucket, attack_category, "
            "dataset_source, count(*) AS event_count FROM flows GROUP BY ALL"),
        "behavioral_profiles": _with(flows) + (
            "SELECT src_ip, dataset_source, count(*) AS total_events, "
            f"count(*) FILTER (WHERE {not_benign}) AS attack_events, "
            f"{R('avg(flow_duration)')} AS avg_flow_duration, {R('avg(flow_bytes_s)')} AS avg_flow_bytes_s, "
            "CAST(sum(syn_flag_count) AS BIGINT) AS total_syn_flags FROM flows "
            "WHERE src_ip IS NOT NULL GROUP BY src_ip, dataset_source "
            "ORDER BY total_events DESC, src_ip, dataset_source LIMIT 10000"),
        "benign_baseline": _with(flows) + (
            f"SELECT count(*) AS benign_count, {R('avg(flow_duration)')} AS avg_flow_duration, "
            f"{R('avg(flow_bytes_s)')} AS avg_flow_bytes_s, {R('avg(flow_packets_s)')} AS avg_flow_packets_s, "
            f"{R('avg(total_fwd_packets)')} AS avg_fwd_packets, {R('avg(total_bwd_packets)')} AS avg_bwd_packets, "
            f"{R('max(flow_bytes_s)')} AS max_flow_bytes_s FROM flows WHERE attack_category = 'Benign' "
            "HAVING count(*) > 0"),
        "day_distincts": _with(flows) + (
            "SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, dataset_source, count(*) AS event_count, "
            "count(DISTINCT src_ip) AS src_ip, count(DISTINCT dst_port) AS dst_port, count(DISTINCT label) AS label, "
            "TRUE AS near_src_ip, TRUE AS near_dst_port, TRUE AS near_label FROM flows GROUP BY ALL"),
        "baseline_filters": _with(flows) + (
            "SELECT 'all' AS input, count(*) AS benign_count FROM flows WHERE attack_category = 'Benign' HAVING count(*) > 0 "
            "UNION ALL SELECT 'all_flows', count(*) FROM flows "
            "UNION ALL SELECT 'no_benign_flows', count(*) FROM flows WHERE attack_category <> 'Benign' "
            "UNION ALL SELECT 'no_flows_flows', CAST(0 AS BIGINT)"),
        "window_metrics_5m": _with(dense, five) + f"SELECT {WINDOW_OUT} FROM windows",
        "window_alerts_5m": _with(dense, five) + f"SELECT {WINDOW_OUT} FROM windows WHERE is_alert",
        "sql_functions": _with(flows) + "SELECT label, attack_category, severity_level, produced_at_ts FROM flows",
        "window_metrics_1d": _with(flows, day) + f"SELECT {WINDOW_OUT} FROM windows",
        "window_metrics_dst_port": _with(flows, windows_cte("1 hour", 5000, 0.8, key="dst_port")) + (
            "SELECT " + WINDOW_OUT.replace("src_ip, ", "dst_port, ", 1) + " FROM windows"),
        "window_alerts": _with(flows, day) + f"SELECT {WINDOW_OUT} FROM windows WHERE is_alert",
        "aggregation_summary": _with(flows, day) + SUMMARY,
        "recent_attacks": _with(flows) + recent,
        "top_src_ips": _with(flows) + (
            "SELECT src_ip, dataset_source, count(*) AS total_events, "
            f"count(*) FILTER (WHERE {not_benign}) AS attack_events, "
            "max(syn_flag_count) AS max_syn_flag_count FROM flows WHERE src_ip IS NOT NULL "
            "GROUP BY ALL ORDER BY attack_events DESC, src_ip, dataset_source LIMIT 1000"),
        "hourly_traffic": _with(flows) + (
            "SELECT date_trunc('hour', event_timestamp) AS hour_bucket, attack_category, "
            f"dataset_source, count(*) AS event_count, {R('avg(flow_bytes_s)')} AS avg_flow_bytes_s "
            "FROM flows GROUP BY ALL"),
        "active_alerts": _with(flows, day) + (
            f"SELECT src_ip, dataset_source, event_count, {R('syn_flag_ratio')} AS syn_flag_ratio, "
            "alert_reason, window_start, window_end FROM windows "
            f"WHERE is_alert AND {_since_yesterday('window_start_date')}"),
        "sample_active_alerts": _with(flows, day) + (
            f"SELECT src_ip, dataset_source, event_count, {R('syn_flag_ratio')} AS syn_flag_ratio, "
            "alert_reason, window_start, window_end FROM windows "
            f"WHERE is_alert AND {_since_yesterday('window_start_date')} "
            "ORDER BY window_start DESC, src_ip NULLS FIRST, dataset_source LIMIT 20"),
        "sample_top_src_ips": _with(flows) + (
            "SELECT src_ip, dataset_source, count(*) AS total_events, "
            f"count(*) FILTER (WHERE {not_benign}) AS attack_events, "
            "max(syn_flag_count) AS max_syn_flag_count FROM flows WHERE src_ip IS NOT NULL "
            "GROUP BY ALL ORDER BY attack_events DESC, src_ip, dataset_source LIMIT 10"),
        "attack_counts_24h": _with(flows) + (
            "SELECT attack_category, severity_level, count(*) AS cnt FROM flows "
            f"WHERE {_since_yesterday('partition_date')} GROUP BY ALL"),
        "total_attacks_24h": _with(flows) + (
            f"SELECT CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_attacks FROM ({recent})"),
        "category_distribution": _with(flows) + (
            "SELECT attack_category, count(*) AS event_count FROM flows GROUP BY ALL"),
        "hourly_attack_volume": _with(flows) + (
            "SELECT date_trunc('hour', event_timestamp) AS hour_bucket, count(*) AS event_count "
            f"FROM flows WHERE {not_benign} GROUP BY ALL"),
        "top_attack_types": _with(flows) + (
            f"SELECT attack_category, count(*) AS event_count FROM flows WHERE {not_benign} "
            "GROUP BY ALL ORDER BY event_count DESC, attack_category LIMIT 10"),
        "top_attack_sources": _with(flows) + (
            f"SELECT src_ip, count(*) AS attack_events FROM flows WHERE src_ip IS NOT NULL AND {not_benign} "
            "GROUP BY ALL ORDER BY attack_events DESC, src_ip LIMIT 20"),
        "attack_heatmap": _with(flows) + (
            "SELECT CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week, "
            "CAST(hour(event_timestamp) AS INTEGER) AS hour_of_day, count(*) AS event_count "
            f"FROM flows WHERE {not_benign} GROUP BY ALL"),
    }


_MID_TS = ("(SELECT CAST(CAST(min(ts) AS DATE) + CAST((date_diff('day', CAST(min(ts) AS DATE), "
           "CAST(max(ts) AS DATE)) + 1) // 2 AS INTEGER) AS TIMESTAMP) FROM events)")
_CLOSE = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 MINUTE FROM events)"
_MS_TS = "date_trunc('millisecond', e.ts)"

ALERT_TEXT = (
    "concat('\U0001f6a8 ALERT [', upper(coalesce(dataset_source, '?')), '] ', "
    "coalesce(strftime(window_start, '%Y-%m-%dT%H:%M:%S'), ''), chr(10), "
    "'   src_ip       : ', coalesce(src_ip, 'N/A'), chr(10), "
    "'   reason       : ', coalesce(alert_reason, 'UNKNOWN'), chr(10), "
    "'   event_count  : ', format('{:,}', coalesce(event_count, 0)), chr(10), "
    "'   syn_ratio    : ', printf('%.3f', coalesce(syn_flag_ratio, 0.0)), chr(10), "
    "'   unique_ports : ', CAST(coalesce(unique_dst_ports, 0) AS VARCHAR), chr(10))"
)


def _in_layout(bodies: dict[str, str]) -> str:
    """All rows of several relations in the common layout."""
    return " UNION ALL ".join(f"SELECT {', '.join(layout_columns(name))} FROM ({body}) AS t" for name, body in bodies.items())


def incremental_sql() -> str:
    """The five reports over all flows, in the common layout."""
    batch = batch_sql()
    bodies = {name: batch[name] for name in ("attack_distribution", "hourly_timeseries", "behavioral_profiles", "benign_baseline")}
    bodies["aggregation_summary"] = _with(flows_cte(), windows_cte("5 minutes", 500, 0.8)) + SUMMARY
    return _in_layout(bodies)


def stream_sql() -> dict:
    ms_flows = flows_cte(_MS_TS)
    norm_out = ", ".join(
        R(c) + f" AS {c}" if c in ("flow_duration", "flow_bytes_s", "flow_packets_s") else c
        for c in NORM_COLS)
    late = "late AS (SELECT * FROM flows WHERE event_timestamp >= " + _MID_TS + ")"
    return {
        "stream_normalize": _with(ms_flows) + f"SELECT {norm_out} FROM flows",
        "stream_forward": _with(ms_flows) + f"SELECT src_ip AS key, {norm_out} FROM flows",
        "stream_alert_messages": _with(ms_flows, windows_cte("1 day", 3, 0.8)) + (
            f"SELECT src_ip AS key, {WINDOW_OUT} FROM windows WHERE is_alert AND window_end <= {_CLOSE}"),
        "stream_alert_text": _with(flows_cte(), windows_cte("1 day", 3, 0.8)) + (
            f"SELECT {ALERT_TEXT} AS alert_text FROM windows WHERE is_alert"),
        "stream_quarantine": "SELECT '{\"src_ip\": ' || event_id AS value FROM events WHERE event_id % 10 = 0",
        "catalog_follows_stream": batch_sql()["hourly_traffic"],
        "compacted_view": _with(ms_flows) + (
            f"SELECT read_from, {norm_out} FROM flows CROSS JOIN (VALUES ('view'), ('follower')) AS r(read_from)"),
        "incremental_reports": incremental_sql(),
        "stream_late_rows": _with(
            ms_flows,
            "dealt AS (SELECT *, CASE WHEN produced_at_ts % 100 = 0 THEN 'NO_EVENT_TIME' "
            f"WHEN event_timestamp < {_MID_TS} THEN 'BEHIND_WATERMARK' ELSE 'ON_TIME' END AS kind FROM flows)",
            "ontime AS (SELECT * FROM dealt WHERE kind = 'ON_TIME')", windows_cte("5 minutes", 500, 0.8, src="ontime")) + (
            "SELECT kind, src_ip, dst_port, CASE WHEN kind <> 'NO_EVENT_TIME' THEN event_timestamp END AS event_timestamp, "
            "CAST(1 AS BIGINT) AS n FROM dealt "
            "UNION ALL SELECT 'TOTAL_' || k.kind, NULL, NULL, NULL, count(d.kind) FROM (VALUES ('ON_TIME'), ('BEHIND_WATERMARK'), ('NO_EVENT_TIME')) "
            "AS k(kind) LEFT JOIN dealt d ON d.kind = k.kind GROUP BY k.kind "
            "UNION ALL SELECT 'WINDOW', src_ip, unique_dst_ports, window_start, event_count FROM windows "
            "WHERE window_end <= (SELECT max(event_timestamp) - INTERVAL 2 MINUTE FROM ontime)"),
        "stream_archive": _with(flows_cte()) + (
            "SELECT CAST(dst_port AS VARCHAR) AS destination_port, "
            "CAST(flow_duration AS VARCHAR) AS flow_duration, "
            "CAST(total_fwd_packets AS VARCHAR) AS total_fwd_packets, "
            "CAST(total_bwd_packets AS VARCHAR) AS total_backward_packets, "
            "CAST(flow_bytes_s AS VARCHAR) AS flow_bytes_s, "
            "CAST(flow_packets_s AS VARCHAR) AS flow_packets_s, "
            "CAST(syn_flag_count AS VARCHAR) AS syn_flag_count, label, partition_date, "
            "produced_at_ts FROM flows"),
        "stream_windows_append": _with(ms_flows, windows_cte("5 minutes", 500, 0.8)) + (
            f"SELECT {WINDOW_OUT} FROM windows WHERE window_end <= {_CLOSE}"),
        "stream_windows_late": _with(ms_flows, late, windows_cte("5 minutes", 500, 0.8, src="late")) + (
            f"SELECT {WINDOW_OUT} FROM windows WHERE window_end <= {_CLOSE}"),
        "stream_alerts_latest": _with(flows_cte(), windows_cte("1 day", 3, 0.8)) + (
            f"SELECT {WINDOW_OUT} FROM windows WHERE is_alert"),
        "alert_text": _with(flows_cte(), windows_cte("1 day", 3, 0.8)) + (
            f"SELECT {ALERT_TEXT} AS alert_text FROM windows WHERE is_alert"),
    }


def _text(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), '')"


def _json_str(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || {c} || '\"' END"


SUMMARY = ("SELECT dataset_source, window_start_date, count(*) AS window_count, "
           "CAST(sum(event_count) AS BIGINT) AS total_events, "
           f"{R('avg(avg_flow_bytes_s)')} AS avg_flow_bytes_s, "
           "count(*) FILTER (WHERE is_alert) AS alert_windows FROM windows GROUP BY ALL")


def source_sql() -> dict:
    flows = flows_cte()
    five, batch = windows_cte("5 minutes", 500, 0.8), batch_sql()
    texts = {c: _text(c) for c in FLOW_COLS}
    texts["label"] = "coalesce(label, '')"
    first_half = f"event_timestamp < {_MID_TS}"
    cic_syn = (f"CASE WHEN dataset_source <> 'cicids' AND {first_half} THEN NULL "
               f"ELSE {texts['syn_flag_count']} END")
    unsw_label = "CASE WHEN label = '' THEN CAST(event_id % 2 AS VARCHAR) ELSE label END"

    def select(overrides: dict, source: str) -> str:
        cols = [f"{overrides.get(c, texts[c])} AS {c}" for c in list(FLOW_COLS) + ["label"]]
        return "SELECT " + ", ".join(cols) + f", {source} AS dataset_source FROM flows"

    cic_source = "CASE WHEN dataset_source = 'cicids' THEN 'cicids' ELSE 'cicdos' END"
    unsw_over = {"syn_flag_count": "CAST(NULL AS VARCHAR)", "label": unsw_label}
    # published payload: the ingest reads cicids/cicdos rows as CICFlow CSV and unsw rows as UNSW
    pub = ("pub AS (SELECT *, CASE dataset_source WHEN 'unsw' THEN 'raw-unsw' WHEN 'cicids' "
           "THEN 'raw-cicids' ELSE 'raw-cicdos' END AS topic FROM (SELECT "
           + ", ".join(
               f"CASE WHEN dataset_source = 'unsw' THEN {unsw_over.get(c, texts[c])} "
               f"WHEN {c!r} = 'syn_flag_count' THEN {cic_syn} ELSE {texts[c]} END AS {c}".replace(
                   f"WHEN '{c}' = 'syn_flag_count' THEN {cic_syn} ",
                   f"WHEN TRUE THEN {cic_syn} " if c == "syn_flag_count" else "")
               for c in list(FLOW_COLS) + ["label"])
           + ", dataset_source FROM flows))")
    fields = list(FLOW_COLS) + ["label", "dataset_source"]
    body = " || ',' || ".join(f"'\"{c}\":' || {_json_str(c)}" for c in fields)
    unsw_body = " || ',' || ".join(f"'\"{c}\":' || {_json_str(c)}" for c in fields
                                   if c != "syn_flag_count")
    value = (f"'{{' || CASE WHEN dataset_source = 'unsw' THEN {unsw_body} ELSE {body} END "
             "|| ',\"produced_at_ts\":1704067200000}'")
    key = "coalesce(nullif(src_ip, ''), 'unknown')"
    ms_flows = flows_cte(_MS_TS)
    norm_out = ", ".join(
        R(c) + f" AS {c}" if c in ("flow_duration", "flow_bytes_s", "flow_packets_s") else c
        for c in NORM_COLS)
    return {
        "csv_cicflow_source": _with(flows) + select({"syn_flag_count": cic_syn}, cic_source),
        "csv_unsw_source": _with(flows) + select(unsw_over, "'unsw'"),
        "zip_csv_source": _with(flows) + select({}, "'cicids'"),
        "publish_payload": _with(flows, pub) + f"SELECT {key} AS key, {value} AS value, topic FROM pub",
        "ingest_ledger": _with(flows, pub) + f"SELECT {key} AS key, {value} AS value, topic FROM pub",
        "json_round_trip": _with(ms_flows) + f"SELECT {norm_out} FROM flows",
        "report_job": _with(flows) + (
            "SELECT date_trunc('hour', event_timestamp) AS hour_bucket, attack_category, "
            "dataset_source, count(*) AS event_count FROM flows GROUP BY ALL"),
        "report_distribution": batch["attack_distribution"],
        "report_profiles": batch["behavioral_profiles"],
        "report_baseline": batch["benign_baseline"],
        "report_summary": _with(flows, five) + SUMMARY,
        "catalog_tables": _in_layout({
            "normalized_logs": _with(flows) + f"SELECT {norm_out} FROM flows",
            "aggregations_5min": _with(flows, five) + f"SELECT {WINDOW_OUT} FROM windows",
            "attack_distribution": batch["attack_distribution"], "hourly_timeseries": batch["hourly_timeseries"],
            "behavioral_profiles": batch["behavioral_profiles"], "benign_baseline": batch["benign_baseline"],
            "aggregation_summary": _with(flows, five) + SUMMARY}),
        "catalog_views": _in_layout({
            **{v: batch[v] for v in ("recent_attacks", "top_src_ips", "hourly_traffic")},
            "active_alerts": _with(flows, five) + (
                f"SELECT src_ip, dataset_source, alert_reason, window_start, event_count, {R('syn_flag_ratio')} AS syn_flag_ratio "
                f"FROM windows WHERE is_alert AND {_since_yesterday('window_start_date')}")}),
        "partitioned_tables": _with(flows) + (
            "SELECT attack_category, partition_date, count(*) AS event_count, "
            "CAST(NULL AS BIGINT) AS benign_count FROM flows GROUP BY ALL UNION ALL "
            "SELECT 'Benign', NULL, NULL, count(*) FROM flows WHERE attack_category = 'Benign' "
            "HAVING count(*) > 0"),
    }
