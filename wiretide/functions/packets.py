"""Packet-level expressions: protocol, ports, TCP state, payload, optional fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# IP protocol numbers and typical header sizes in bytes.
IP_PROTOCOL_NUMBERS = {6: "TCP", 17: "UDP", 1: "ICMP"}
IP_HEADER_BYTES = 20
TRANSPORT_HEADER_BYTES = {"TCP": 20, "UDP": 8, "ICMP": 8}


def protocol_from_layers(layers: Column) -> Column:
    """Protocol of a packet given the array of its layer names; TCP wins over UDP over ICMP."""
    name = F.lit("OTHER")
    for layer in ("ICMP", "UDP", "TCP"):
        name = F.when(F.array_contains(layers, layer), layer).otherwise(name)
    return name


def protocol_from_number(number: Column) -> Column:
    """Protocol of a packet given its IP protocol number."""
    name = F.lit("OTHER")
    for code, label in IP_PROTOCOL_NUMBERS.items():
        name = F.when(number == code, label).otherwise(name)
    return name


def port_or_null(port: Column, protocol: Column) -> Column:
    """Only TCP and UDP carry ports."""
    return F.when(protocol.isin("TCP", "UDP"), port)


def connection_state(tcp_flags: Column, protocol: Column) -> Column:
    """Connection state told by one packet's TCP flags."""
    flags = F.upper(tcp_flags)
    of_tcp = (
        F.when(tcp_flags.isNull() | (tcp_flags == ""), "UNKNOWN")
        .when(flags.contains("R"), "CLOSED")
        .when(flags.contains("F"), "CLOSING")
        .when(flags == "S", "NEW")
        .when(flags.contains("A") | flags.contains("P"), "ESTABLISHED")
        .otherwise("UNKNOWN")
    )
    return F.when(protocol.eqNullSafe("TCP"), of_tcp).otherwise("STATELESS")


def estimated_payload(length: Column, protocol: Column) -> Column:
    """Packet length less typical headers, never below zero."""
    header = F
    for name, size in TRANSPORT_HEADER_BYTES.items():
        header = header.when(protocol == name, size)
    header = header.otherwise(0)
    return F.when(length.isNotNull(), F.greatest(length - IP_HEADER_BYTES - header, F.lit(0))).cast("bigint")


def extra_field(extra: Column, key: str, default: Column | None = None) -> Column:
    """Read a key of an open map; the default applies only where the key is absent."""
    fallback = F.lit(None) if default is None else default
    return F.when(F.map_contains_key(extra, key), F.try_element_at(extra, F.lit(key))).otherwise(fallback)
