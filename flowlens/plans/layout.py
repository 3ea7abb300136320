"""One layout for rows of different tables, so that a check compares them all:
up to four texts, three counts and six means, by SQL that Spark and DuckDB share."""

from __future__ import annotations

REPORTS = {
    "attack_distribution": (["attack_category", "severity_level", "dataset_source"], ["event_count"], []),
    "hourly_timeseries": (["CAST(hour_bucket AS STRING)", "attack_category", "dataset_source"], ["event_count"], []),
    "behavioral_profiles": (["src_ip", "dataset_source"], ["total_events", "attack_events", "total_syn_flags"], ["avg_flow_duration", "avg_flow_bytes_s"]),
    "benign_baseline": ([], ["benign_count"], ["avg_flow_duration", "avg_flow_bytes_s", "avg_flow_packets_s", "avg_fwd_packets", "avg_bwd_packets", "max_flow_bytes_s"]),
    "aggregation_summary": (["dataset_source", "window_start_date"], ["window_count", "total_events", "alert_windows"], ["avg_flow_bytes_s"]),
}
TABLES = {
    "normalized_logs": (["src_ip", "label", "attack_category", "CAST(partition_date AS STRING)"], ["src_port", "dst_port", "syn_flag_count"],
                        ["flow_duration", "flow_bytes_s", "flow_packets_s"]),
    "aggregations_5min": (["src_ip", "dataset_source", "CAST(window_start AS STRING)", "alert_reason"], ["event_count", "total_syn_flags", "unique_dst_ports"],
                          ["avg_flow_duration", "avg_flow_bytes_s", "syn_flag_ratio"]),
}
VIEWS = {
    "recent_attacks": (["attack_category", "severity_level", "label", "dataset_source"], ["event_count"], []),
    "top_src_ips": (["src_ip", "dataset_source"], ["total_events", "attack_events", "max_syn_flag_count"], []),
    "hourly_traffic": (["CAST(hour_bucket AS STRING)", "attack_category", "dataset_source"], ["event_count"], ["avg_flow_bytes_s"]),
    "active_alerts": (["src_ip", "dataset_source", "alert_reason", "CAST(window_start AS STRING)"], ["event_count"], ["syn_flag_ratio"]),
}


def layout_columns(name: str) -> list[str]:
    """SQL columns of a report, table or view in the common layout."""
    texts, counts, means = (REPORTS | TABLES | VIEWS)[name]
    pad = lambda own, n, kind: [f"CAST({c} AS {kind})" for c in own + ["NULL"] * (n - len(own))]
    columns = {"k": pad(texts, 4, "STRING"), "n": pad(counts, 3, "BIGINT"), "x": pad(means, 6, "DOUBLE")}
    return [f"'{name}' AS relation"] + [f"{c} AS {p}{i + 1}" for p, own in columns.items() for i, c in enumerate(own)]
