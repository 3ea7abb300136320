"""Schemas and column maps of the flow-log data model.

Every raw value travels as text; numbers appear only in ``normalize``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def with_fields(schema: StructType, *fields) -> StructType:
    """A copy of ``schema`` with ``(name, type)`` fields appended."""
    from pyspark.sql.types import _parse_datatype_string

    extra = [StructField(n, _parse_datatype_string(t) if isinstance(t, str) else t, True)
             for n, t in fields]
    return StructType(list(schema.fields) + extra)


def _strings(names):
    return [StructField(n, StringType(), True) for n in names]


# The flow fields every raw message carries, in message order.
FLOW_FIELDS = [
    "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "flow_duration",
    "total_fwd_packets", "total_bwd_packets", "flow_bytes_s", "flow_packets_s",
    "syn_flag_count", "label",
]

# Raw message: 13 strings and the producer's clock in epoch millis.
RAW_SCHEMA = StructType(
    _strings(FLOW_FIELDS + ["dataset_source"])
    + [StructField("produced_at_ts", LongType(), True)]
)

# Numeric fields of the unified row and their types.
LONG_FIELDS = ["src_port", "dst_port", "total_fwd_packets", "total_bwd_packets", "syn_flag_count"]
DOUBLE_FIELDS = ["flow_duration", "flow_bytes_s", "flow_packets_s"]

_UNIFIED_TYPES = {
    **{n: LongType() for n in LONG_FIELDS},
    **{n: DoubleType() for n in DOUBLE_FIELDS},
}

# Unified row as the window job reads it (no produced_at_ts).
UNIFIED_SCHEMA = StructType(
    [StructField(n, _UNIFIED_TYPES.get(n, StringType()), True) for n in FLOW_FIELDS]
    + _strings(["attack_category", "severity_level", "dataset_source"])
    + [
        StructField("event_timestamp", TimestampType(), True),
        StructField("partition_date", StringType(), True),
    ]
)

# Columns of a normalised row as Job 1 writes them: raw order, then enrichments.
NORMALIZED_COLUMNS = (
    FLOW_FIELDS
    + ["dataset_source", "produced_at_ts", "attack_category", "severity_level",
       "event_timestamp", "partition_date"]
)

NORMALIZED_SCHEMA = StructType(
    [StructField(n, _UNIFIED_TYPES.get(n, StringType()), True) for n in FLOW_FIELDS]
    + [
        StructField("dataset_source", StringType(), True),
        StructField("produced_at_ts", LongType(), True),
        StructField("attack_category", StringType(), True),
        StructField("severity_level", StringType(), True),
        StructField("event_timestamp", TimestampType(), True),
        StructField("partition_date", StringType(), True),
    ]
)
NORMALIZED_PARTITIONS = ["attack_category", "partition_date"]

# Window row in output order; processed_at is the job's clock.
WINDOW_SCHEMA = StructType([
    StructField("src_ip", StringType(), True),
    StructField("dataset_source", StringType(), True),
    StructField("event_count", LongType(), False),
    StructField("unique_labels", LongType(), True),
    StructField("unique_dst_ports", LongType(), True),
    StructField("avg_flow_duration", DoubleType(), True),
    StructField("avg_flow_bytes_s", DoubleType(), True),
    StructField("total_syn_flags", LongType(), True),
    StructField("total_fwd_packets", LongType(), True),
    StructField("syn_flag_ratio", DoubleType(), True),
    StructField("window_start", TimestampType(), True),
    StructField("window_end", TimestampType(), True),
    StructField("window_start_date", StringType(), True),
    StructField("is_alert", BooleanType(), True),
    StructField("alert_reason", StringType(), True),
    StructField("processed_at", TimestampType(), True),
])
WINDOW_PARTITIONS = ["window_start_date", "dataset_source"]

# CICFlowMeter CSV header (after trimming) -> flow field.
CICFLOW_COLUMN_MAP = {
    "Source IP": "src_ip",
    "Destination IP": "dst_ip",
    "Source Port": "src_port",
    "Destination Port": "dst_port",
    "Protocol": "protocol",
    "Flow Duration": "flow_duration",
    "Total Fwd Packets": "total_fwd_packets",
    "Total Backward Packets": "total_bwd_packets",
    "Flow Bytes/s": "flow_bytes_s",
    "Flow Packets/s": "flow_packets_s",
    "SYN Flag Count": "syn_flag_count",
    "Label": "label",
}

# The 49 UNSW-NB15 columns of a headerless file, in file order.
UNSW_COLUMNS = [
    "srcip", "sport", "dstip", "dsport", "proto", "state", "dur",
    "sbytes", "dbytes", "sttl", "dttl", "sloss", "dloss", "service",
    "sload", "dload", "spkts", "dpkts", "swin", "dwin", "stcpb", "dtcpb",
    "smeansz", "dmeansz", "trans_depth", "res_bdy_len", "sjit", "djit",
    "stime", "ltime", "sintpkt", "dintpkt", "tcprtt", "synack", "ackdat",
    "is_sm_ips_ports", "ct_state_ttl", "ct_flw_http_mthd", "is_ftp_login",
    "ct_ftp_cmd", "ct_srv_src", "ct_srv_dst", "ct_dst_ltm", "ct_src_ltm",
    "ct_src_dport_ltm", "ct_dst_sport_ltm", "ct_dst_src_ltm", "attack_cat", "label",
]

# UNSW column -> flow field (no SYN count in this layout).
UNSW_COLUMN_MAP = {
    "srcip": "src_ip",
    "dstip": "dst_ip",
    "sport": "src_port",
    "dsport": "dst_port",
    "proto": "protocol",
    "dur": "flow_duration",
    "spkts": "total_fwd_packets",
    "dpkts": "total_bwd_packets",
    "sload": "flow_bytes_s",
    "dload": "flow_packets_s",
    "attack_cat": "label",
}

UNSW_SCHEMA = StructType(_strings(UNSW_COLUMNS))

# The legacy archive message, CICIDS2017 features as text.
LEGACY_FEATURES = [
    "destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets",
    "total_length_of_fwd_packets", "total_length_of_bwd_packets",
    "fwd_packet_length_max", "fwd_packet_length_min", "fwd_packet_length_mean",
    "fwd_packet_length_std", "bwd_packet_length_max", "bwd_packet_length_min",
    "bwd_packet_length_mean", "bwd_packet_length_std", "flow_bytes_s", "flow_packets_s",
    "flow_iat_mean", "flow_iat_std", "flow_iat_max", "flow_iat_min",
    "fwd_iat_total", "fwd_iat_mean", "fwd_iat_std", "fwd_iat_max", "fwd_iat_min",
    "bwd_iat_total", "bwd_iat_mean", "bwd_iat_std", "bwd_iat_max", "bwd_iat_min",
    "fwd_psh_flags", "bwd_psh_flags", "fwd_urg_flags", "bwd_urg_flags",
    "fwd_header_length", "bwd_header_length", "fwd_packets_s", "bwd_packets_s",
    "min_packet_length", "max_packet_length", "packet_length_mean", "packet_length_std",
    "packet_length_variance", "fin_flag_count", "syn_flag_count", "rst_flag_count",
    "psh_flag_count", "ack_flag_count", "urg_flag_count", "cwe_flag_count",
    "ece_flag_count", "down_up_ratio", "average_packet_size", "avg_fwd_segment_size",
    "avg_bwd_segment_size", "fwd_avg_bytes_bulk", "fwd_avg_packets_bulk",
    "fwd_avg_bulk_rate", "bwd_avg_bytes_bulk", "bwd_avg_packets_bulk", "bwd_avg_bulk_rate",
    "subflow_fwd_packets", "subflow_fwd_bytes", "subflow_bwd_packets", "subflow_bwd_bytes",
    "init_win_bytes_forward", "init_win_bytes_backward", "act_data_pkt_fwd",
    "min_seg_size_forward", "active_mean", "active_std", "active_max", "active_min",
    "idle_mean", "idle_std", "idle_max", "idle_min",
]

LEGACY_SCHEMA = StructType(
    _strings(LEGACY_FEATURES + ["label", "partition_date"])
    + [StructField("produced_at_ts", LongType(), True)]
)

# Report layouts (without the clock column generated_at).
REPORT_COLUMNS = {
    "attack_distribution": ["attack_category", "severity_level", "dataset_source", "event_count"],
    "hourly_timeseries": ["hour_bucket", "attack_category", "dataset_source", "event_count"],
    "behavioral_profiles": ["src_ip", "dataset_source", "total_events", "attack_events",
                            "avg_flow_duration", "avg_flow_bytes_s", "total_syn_flags"],
    "benign_baseline": ["benign_count", "avg_flow_duration", "avg_flow_bytes_s",
                        "avg_flow_packets_s", "avg_fwd_packets", "avg_bwd_packets",
                        "max_flow_bytes_s"],
    "aggregation_summary": ["dataset_source", "window_start_date", "window_count",
                            "total_events", "avg_flow_bytes_s", "alert_windows"],
}
