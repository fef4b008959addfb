"""Flow summaries on a stream, by session windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.functions.flowkey import with_flow_identity
from wiretide.functions.packets import connection_state
from wiretide.operators.packets import split_valid
from wiretide.schemas import MICROS, ExtractionConfig


def end_mark(packets: DataFrame, delay_seconds: float = 10.0, config: ExtractionConfig = ExtractionConfig()) -> DataFrame:
    """One packet so long after the last that it closes every session; its own session stays open.

    A source that ends sends it last, with the delay of its stream.
    """
    after = config.timeout_us + round(2 * delay_seconds * MICROS) + MICROS
    nowhere = F.lit("0.0.0.0")
    return packets.agg((F.max("ts_us") + after).alias("ts_us")).select(
        "ts_us", nowhere.alias("src_ip"), nowhere.alias("dst_ip"), F.lit("OTHER").alias("protocol"), F.lit(0).cast("bigint").alias("length")
    )


def flow_summary_stream(
    packets: DataFrame, delay: str = "10 seconds", config: ExtractionConfig = ExtractionConfig()
) -> DataFrame:
    """Flow sessions of a packet stream, each given out once, when the watermark has passed its end.

    Packets later than the delay are dropped, as in any watermarked aggregation;
    ``late.part_late`` sets them aside first. Sessions
    still open when a stream ends are given out after the packet of ``end_mark``. Packets
    of a session are merged where they are read, so a busy flow is no load on one task;
    this is a setting of the session.
    """
    packets.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", True)
    usable, _ = split_valid(packets)
    flags = F.col("tcp_flags") if "tcp_flags" in packets.columns else F.lit(None).cast("string")
    rows = (
        with_flow_identity(usable, keep_endpoints=True)
        .withColumn("event_time", F.timestamp_micros("ts_us"))
        .withColumn("_state", connection_state(flags, F.col("protocol")))
        .withWatermark("event_time", delay)
    )
    order = F.struct("ts_us", "packet_id")
    keys = ("flow_id", "endpoint_1_ip", "endpoint_1_port", "endpoint_2_ip", "endpoint_2_port", "protocol")
    gap = F.session_window("event_time", f"{config.timeout_us} microseconds")
    grouped = rows.groupBy(gap.alias("window"), "flow_hash", *keys).agg(
        F.min("ts_us").alias("start_us"),
        F.max("ts_us").alias("last_seen_us"),
        F.count(F.lit(1)).alias("total_packets"),
        F.sum("length").alias("total_bytes"),
        F.max_by("_state", order).alias("connection_state"),
        F.min_by("src_ip", order).alias("initiator_ip"),
    )
    return grouped.select(
        *keys, "start_us", "last_seen_us", "total_packets", "total_bytes", "connection_state", "initiator_ip",
        (F.col("last_seen_us") - F.col("start_us")).alias("duration_us"),
    )
