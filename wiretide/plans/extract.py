"""From packets to per-packet features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.functions.flowkey import with_flow_identity
from wiretide.functions.netaddr import with_direction
from wiretide.functions.packets import connection_state
from wiretide.operators.flows import add_avg_flow_time
from wiretide.operators.layout import TIME_ORDER, LayoutOptions, plan_layout
from wiretide.operators.packets import split_valid, with_metadata
from wiretide.operators.sessions import with_flow_statistics
from wiretide.operators.tracking import scan
from wiretide.schemas import FEATURE_SCHEMA, MICROS, ExtractionConfig


def feature_columns(scanned: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project a flow scan to the feature record, plus the columns named in ``keep``."""
    seconds = F.col("ts_us") / F.lit(float(MICROS))
    described = with_metadata(with_flow_statistics(scanned)).withColumns(
        {"packet_length": F.col("length"), "timestamp": seconds, "packet_arrival_time": seconds}
    )
    described = described.withColumn("connection_state", connection_state(F.col("tcp_flags"), F.col("protocol")))
    # The record has an open slot of its own, empty until a user fills it.
    described = described.withColumn("extra", F.create_map().cast("map<string,string>"))
    names = [f.name for f in FEATURE_SCHEMA.fields if f.name != "avg_flow_time" or "avg_flow_time" in scanned.columns]
    return described.select(*names, *keep)


def extract_features(
    packets: DataFrame,
    config: ExtractionConfig = ExtractionConfig(),
    order: tuple[str, ...] = TIME_ORDER,
    avg_flow_time: bool = True,
    options: LayoutOptions = LayoutOptions(),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One feature row per usable packet, with the packet columns named in ``keep`` added.

    Unusable packets are left out; ``split_valid`` gives them with the reason.
    ``avg_flow_time`` is the one feature that looks across flows and costs a second
    shuffle, so it can be switched off.
    """
    usable, _ = split_valid(packets)
    rows = with_flow_identity(usable)
    layout = plan_layout(rows, order, options)
    scanned = with_direction(scan(rows, config, layout), config.home_networks)
    if avg_flow_time:
        scanned = add_avg_flow_time(scanned, layout)
    return feature_columns(scanned, keep)
