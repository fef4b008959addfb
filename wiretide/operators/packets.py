"""Packet intake: drop malformed rows, keep supported protocols, limit, dead-letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.functions.packets import estimated_payload, extra_field, port_or_null
from wiretide.operators.layout import INNER, LayoutOptions, plan_layout
from wiretide.schemas import MICROS, PACKET_SCHEMA, SUPPORTED_PROTOCOLS

# A packet without one of these cannot be assigned to a flow or counted.
REQUIRED = ("src_ip", "dst_ip", "length", "ts_us")

# Optional fields that are numbers, and their types.
NUMBERS = {"ttl": "int", "window_size": "int", "payload_size": "bigint"}


def drop_malformed(packets: DataFrame) -> DataFrame:
    """Drop packets without addresses or length."""
    return packets.filter(
        F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull() & F.col("length").isNotNull()
    )


def keep_supported(packets: DataFrame) -> DataFrame:
    """Keep TCP, UDP and ICMP; a plain predicate that reaches the scan."""
    return packets.filter(F.col("protocol").isin(*SUPPORTED_PROTOCOLS))


def project_packets(packets: DataFrame) -> DataFrame:
    """The packet record: known columns only, ports only where the protocol has them."""
    columns = [f.name for f in PACKET_SCHEMA.fields if f.name in packets.columns]
    if "extra" in packets.columns:
        columns.append("extra")
    ports = {name: port_or_null(F.col(name), F.col("protocol")) for name in ("src_port", "dst_port")}
    return packets.select(*[ports[c].alias(c) if c in ports else F.col(c) for c in columns])


def capture(packets: DataFrame) -> DataFrame:
    """What a capture yields from raw packet rows."""
    return project_packets(keep_supported(drop_malformed(packets)))


def capture_limit(
    packets: DataFrame,
    packet_count: int = 0,
    timeout_seconds: float | None = None,
    options: LayoutOptions = LayoutOptions(),
) -> DataFrame:
    """The first packets of a capture, by number (0 is no limit) and by time since the first one.

    Packets without a time are not among the first of anything and are left out.
    """
    out = packets.filter(F.col("ts_us").isNotNull())
    if packet_count <= 0 and timeout_seconds is None:
        return packets
    if timeout_seconds is not None:
        end = packets.agg(F.min("ts_us").alias("t")).scalar() + round(timeout_seconds * MICROS)
        out = out.filter(F.col("ts_us") < end)
    if packet_count <= 0:
        return out
    # Slices before the one in which the count ends are kept whole; only that one is put in order.
    layout = plan_layout(out, options=options)
    sliced = layout.with_slice(out)
    left, last, inside = packet_count, None, sliced
    by_top = [F.floor(F.col("_slice") / INNER)] if layout.inner is not None else []
    for level in (*by_top, F.col("_slice")):
        last = None
        for number, rows in sorted(inside.groupBy(level.alias("part")).count().collect()):
            if rows >= left:
                last = number
                break
            left -= rows
        if last is None:
            return out
        inside = inside.filter(level == last)
    ends = sliced.filter(F.col("_slice") == last).orderBy("ts_us", "packet_id").limit(left)
    return sliced.filter(F.col("_slice") < last).unionAll(ends).drop("_slice")


def packet_error(columns: list[str]) -> Column:
    """Why a packet cannot be used, null where it can: a missing field, or an optional one that is no number."""
    error = F
    for name in REQUIRED:
        error = error.when(F.col(name).isNull(), f"{name} is missing")
    for name in NUMBERS if "extra" in columns else ():
        value = extra_field(F.col("extra"), name)
        error = error.when(value.isNotNull() & value.try_cast(NUMBERS[name]).isNull(), f"{name} is unreadable")
    return error.otherwise(F.lit(None).cast("string"))


def split_valid(packets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable packets, and the rest with the reason in column ``error``.

    Runs before any per-flow state is built, so a bad row cannot disturb the counters.
    """
    usable = packets
    for name in REQUIRED:
        usable = usable.filter(F.col(name).isNotNull())
    error = packet_error(packets.columns)
    if "extra" in packets.columns:
        usable = usable.filter(error.isNull())
    rejected = packets.withColumn("error", error).filter(F.col("error").isNotNull())
    return usable, rejected


def with_metadata(packets: DataFrame) -> DataFrame:
    """Give every packet typed ttl, tcp_flags, window_size and payload_size columns.

    Read from the open ``extra`` map if the table has one, where a present null
    payload stays null; otherwise from typed columns, absent ones being null.
    """
    estimate = estimated_payload(F.col("length"), F.col("protocol"))
    if "extra" in packets.columns:
        extra = F.col("extra")
        return packets.withColumns(
            {
                "ttl": extra_field(extra, "ttl").try_cast("int"),
                "tcp_flags": extra_field(extra, "tcp_flags").cast("string"),
                "window_size": extra_field(extra, "window_size").try_cast("int"),
                "payload_size": extra_field(extra, "payload_size", estimate.cast("string")).try_cast("bigint"),
            }
        )
    typed = {
        name: F.lit(None).cast(PACKET_SCHEMA[name].dataType)
        for name in ("ttl", "tcp_flags", "window_size")
        if name not in packets.columns
    }
    known = F.col("payload_size").cast("bigint") if "payload_size" in packets.columns else F.lit(None)
    return packets.withColumns({**typed, "payload_size": F.coalesce(known, estimate)})
