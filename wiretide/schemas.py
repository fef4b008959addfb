"""Record schemas, closed vocabularies and settings."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Closed vocabularies of the data model.
PROTOCOLS = ("TCP", "UDP", "ICMP", "OTHER")
SUPPORTED_PROTOCOLS = ("TCP", "UDP", "ICMP")
DIRECTIONS = ("INBOUND", "OUTBOUND", "INTERNAL", "UNKNOWN")
CONNECTION_STATES = ("NEW", "ESTABLISHED", "CLOSING", "CLOSED", "STATELESS", "UNKNOWN")
ATTACK_CATEGORIES = (
    "BENIGN",
    "PORT_SCAN",
    "DDOS",
    "BRUTE_FORCE",
    "MALWARE",
    "PHISHING",
    "BOTNET",
    "DATA_EXFILTRATION",
    "UNKNOWN",
)
THREAT_LABELS = ("BENIGN", "MALICIOUS", "SUSPICIOUS", "UNKNOWN")
SEVERITIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")

# Model inputs, in the order of the feature vector.
NUMERIC_FEATURES = (
    "packet_length",
    "flow_duration",
    "packet_rate",
    "byte_rate",
    "payload_size",
    "avg_packet_size",
    "total_packets_in_flow",
    "total_bytes",
    "inter_arrival_time",
    "ttl",
    "window_size",
    "avg_flow_time",
)
CATEGORICAL_FEATURES = ("protocol", "direction", "connection_state")
FEATURE_ORDER = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Numeric codes of the categorical inputs.
CATEGORY_CODES = {
    "protocol": {"TCP": 0, "UDP": 1, "ICMP": 2, "OTHER": 3, "UNKNOWN": 4},
    "direction": {"INBOUND": 0, "OUTBOUND": 1, "INTERNAL": 2, "UNKNOWN": 3},
    "connection_state": {
        "NEW": 0,
        "ESTABLISHED": 1,
        "CLOSING": 2,
        "CLOSED": 3,
        "STATELESS": 4,
        "UNKNOWN": 5,
    },
}

MICROS = 1_000_000

PACKET_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("ttl", T.IntegerType()),
        T.StructField("tcp_flags", T.StringType()),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("payload_size", T.IntegerType()),
    ]
)

# The same record with the optional fields left in one open map.
PACKET_WITH_EXTRA_SCHEMA = T.StructType(
    list(PACKET_SCHEMA.fields[:8]) + [T.StructField("extra", T.MapType(T.StringType(), T.StringType()))]
)

FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("packet_length", T.LongType()),
        T.StructField("timestamp", T.DoubleType()),
        T.StructField("ttl", T.IntegerType()),
        T.StructField("tcp_flags", T.StringType()),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("direction", T.StringType()),
        T.StructField("flow_id", T.StringType()),
        T.StructField("flow_duration", T.DoubleType()),
        T.StructField("connection_state", T.StringType()),
        T.StructField("total_packets_in_flow", T.LongType()),
        T.StructField("total_bytes", T.LongType()),
        T.StructField("avg_packet_size", T.DoubleType()),
        T.StructField("payload_size", T.LongType()),
        T.StructField("packet_arrival_time", T.DoubleType()),
        T.StructField("inter_arrival_time", T.DoubleType()),
        T.StructField("packet_rate", T.DoubleType()),
        T.StructField("byte_rate", T.DoubleType()),
        T.StructField("avg_flow_time", T.DoubleType()),
        T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("threat_label", T.StringType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("attack_category", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("prediction_timestamp", T.DoubleType()),
        T.StructField("class_probabilities", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("flow_id", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ExtractionConfig:
    """Settings of feature extraction."""

    # Default home networks and idle timeout.
    home_networks: tuple[str, ...] = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8")
    flow_timeout_seconds: float = 60.0
    # Idle flows end at once by default, or only at sweeps so far apart.
    cleanup_interval_seconds: float | None = None
    # Flows tracked at a time; a new one then displaces the one seen longest ago. No limit by default.
    max_tracked_flows: int | None = None

    @property
    def timeout_us(self) -> int:
        return round(self.flow_timeout_seconds * MICROS)


@dataclass(frozen=True)
class DetectionConfig:
    """Settings of scoring: severity bands, category weights, where models live."""

    model_directory: str = field(
        default_factory=lambda: os.environ.get("WIRETIDE_MODEL_DIR", os.path.join(os.getcwd(), "trained_models"))
    )
    model_filename: str = "random_forest_threat_model"
    default_model: str = "random_forest"

    # Severity bands with inclusive upper bounds.
    severity_bands: tuple[tuple[str, float], ...] = (
        ("LOW", 30.0),
        ("MEDIUM", 70.0),
        ("HIGH", 90.0),
        ("CRITICAL", 100.0),
    )
    # How dangerous each category is.
    risk_weights: tuple[tuple[str, float], ...] = (
        ("BENIGN", 0.0),
        ("PORT_SCAN", 0.55),
        ("BRUTE_FORCE", 0.70),
        ("PHISHING", 0.75),
        ("BOTNET", 0.85),
        ("MALWARE", 0.90),
        ("DDOS", 0.90),
        ("DATA_EXFILTRATION", 0.95),
        ("UNKNOWN", 0.50),
    )
    default_risk_weight: float = 0.5
    suspicious_ceiling: float = 50.0

    @property
    def model_path(self) -> str:
        return os.path.join(self.model_directory, self.model_filename)
