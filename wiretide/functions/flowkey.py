"""Direction-independent identity of a flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# flow_id is half of a 128-bit identity with flow_hash. Keying on both keeps
# flows apart at any realistic count, sorts on a plain long, and ships 24 bytes
# through the shuffle instead of two addresses and two ports.
FLOW_KEYS = ("flow_hash", "flow_id")


def with_endpoints(packets: DataFrame) -> DataFrame:
    """Add the two (ip, port) ends in sorted order; a missing port counts as 0."""
    sport, dport = F.coalesce("src_port", F.lit(0)), F.coalesce("dst_port", F.lit(0))
    src_ip, dst_ip = F.col("src_ip"), F.col("dst_ip")
    source_first = (src_ip < dst_ip) | ((src_ip == dst_ip) & (sport <= dport))
    source, target = F.struct(src_ip.alias("ip"), sport.alias("port")), F.struct(dst_ip.alias("ip"), dport.alias("port"))
    return (
        packets.withColumn("_source_first", source_first)
        .withColumn("_low", F.when(F.col("_source_first"), source).otherwise(target))
        .withColumn("_high", F.when(F.col("_source_first"), target).otherwise(source))
        .withColumns(
            {
                "endpoint_1_ip": F.col("_low.ip"),
                "endpoint_1_port": F.col("_low.port"),
                "endpoint_2_ip": F.col("_high.ip"),
                "endpoint_2_port": F.col("_high.port"),
            }
        )
        .drop("_source_first", "_low", "_high")
    )


def flow_text() -> Column:
    """Readable flow key, the same for both directions: PROTO:ip1:port1<->ip2:port2."""
    return F.concat(
        F.coalesce("protocol", F.lit("None")),
        F.lit(":"),
        F.concat_ws(":", "endpoint_1_ip", "endpoint_1_port"),
        F.lit("<->"),
        F.concat_ws(":", "endpoint_2_ip", "endpoint_2_port"),
    )


def flow_id(text: Column) -> Column:
    """Short stable id: the first 16 hex digits of the SHA-256 of the flow key."""
    return F.substring(F.sha2(text, 256), 1, 16)


def with_flow_identity(packets: DataFrame, keep_endpoints: bool = False) -> DataFrame:
    """Add flow_hash and flow_id."""
    out = (
        with_endpoints(packets)
        .withColumn("_flow_text", flow_text())
        .withColumn("flow_hash", F.xxhash64("_flow_text"))
        .withColumn("flow_id", flow_id(F.col("_flow_text")))
        .drop("_flow_text")
    )
    if keep_endpoints:
        return out
    return out.drop("endpoint_1_ip", "endpoint_1_port", "endpoint_2_ip", "endpoint_2_port")
