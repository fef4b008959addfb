"""One-line summaries and JSON forms of the three record types.

The texts of the summaries are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.schemas import MICROS


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def seconds_text(ts_us: Column) -> Column:
    """Microseconds as decimal seconds without needless zeros, such as 100.5 or 7.0."""
    whole = F.floor(ts_us / F.lit(MICROS)).cast("bigint")
    fraction = F.lpad((ts_us - whole * MICROS).cast("string"), 6, "0")
    return F.concat(whole.cast("string"), F.lit("."), F.regexp_replace(fraction, r"(?<=.)0+\z", ""))


def packet_summary() -> Column:
    return F.concat(
        F.lit("["), F.col("protocol"), F.lit("] "),
        _shown("src_ip"), F.lit(":"), _shown("src_port"), F.lit(" -> "),
        _shown("dst_ip"), F.lit(":"), _shown("dst_port"),
        F.lit(" len="), _shown("length"),
        F.lit(" ts="), seconds_text(F.col("ts_us")),
    )


def feature_summary() -> Column:
    return F.concat(
        F.lit("FeatureVector[flow="), F.col("flow_id"), F.lit(" "), F.col("protocol"), F.lit(" "),
        _shown("src_ip"), F.lit(":"), _shown("src_port"), F.lit("->"),
        _shown("dst_ip"), F.lit(":"), _shown("dst_port"),
        F.lit(" dir="), F.col("direction"), F.lit(" state="), F.col("connection_state"),
        F.lit(" len="), _shown("packet_length"), F.lit(" pkt#="), _shown("total_packets_in_flow"), F.lit("]"),
    )


def prediction_summary() -> Column:
    return F.format_string(
        "ThreatPrediction[label=%s category=%s confidence=%.2f%% risk=%.2f severity=%s model=%s]",
        "threat_label", "attack_category", "confidence_score", "risk_score", "severity", "model_name",
    )


def as_json(df: DataFrame) -> DataFrame:
    """One JSON document per row; nulls are kept as in the records."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
