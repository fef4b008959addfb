"""IP addresses and traffic direction, as plain column expressions.

An IPv4 address becomes a number and an IPv6 address its 32 hex digits, so that
"is in a network" is a range test that stays inside generated code.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(\.{_OCTET}){{3}}"
_IPV4 = rf"\A{_DOTTED}\z"


def _up_to(groups: int) -> str:
    """Pattern of at most so many hextets, where a dotted tail takes the place of two."""
    hextet = "[0-9a-fA-F]{1,4}"
    if groups == 0:
        return ""
    some = rf"{hextet}(:{hextet}){{0,{groups - 1}}}"
    dotted = rf"|({hextet}:){{0,{groups - 2}}}{_DOTTED}" if groups >= 2 else ""
    return f"({some}{dotted})?"


def _ipv6_pattern() -> str:
    """All spellings of an IPv6 address: eight groups, or fewer around one "::", and a zone."""
    hextet = "[0-9a-fA-F]{1,4}"
    full = rf"({hextet}:){{6}}({hextet}:{hextet}|{_DOTTED})"
    short = [f"::{_up_to(7)}"]
    short += [rf"{hextet}(:{hextet}){{{left - 1}}}::{_up_to(7 - left)}" for left in range(1, 8)]
    return rf"\A({'|'.join([full, *short])})(%[^%]+)?\z"


_IPV6 = _ipv6_pattern()


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, with those that overlap or touch joined."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def parse_networks(networks: Sequence[str]) -> tuple[list[tuple[int, int]], list[tuple[str, str]]]:
    """CIDR texts as sorted ranges that do not touch: IPv4 numbers and IPv6 hex digits."""
    parsed = [ipaddress.ip_network(text, strict=False) for text in networks]
    v4, v6 = (
        _merged([(int(n.network_address), int(n.broadcast_address)) for n in parsed if n.version == version])
        for version in (4, 6)
    )
    return v4, [(f"{low:032x}", f"{high:032x}") for low, high in v6]


def in_ranges(column: str, ranges: Sequence[tuple]) -> Column:
    """True where the column falls in one of the ranges; false for null."""
    tests = [f"{column} BETWEEN {low!r} AND {high!r}" for low, high in ranges]
    return F.expr(f"coalesce({' OR '.join(tests)}, false)") if tests else F.lit(False)


def is_ipv6(ip: Column) -> Column:
    return F.coalesce(ip.contains(":") & ip.rlike(_IPV6), F.lit(False))


def _let(value: Column, body) -> Column:
    """Name an intermediate value, so that it is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ipv6_hex(ip: Column) -> Column:
    """IPv6 text as 32 lower-case hex digits, null where it is not a valid address.

    Written with lambdas, which stay out of the generated code: rows without IPv6
    pay nothing for it and the code around it stays small enough to be compiled.
    """

    def dotted_as_groups(address: Column) -> Column:
        tail = F.substring_index(address, ":", -1)
        pairs = F.transform(F.split(tail, r"\."), lambda octet: F.lpad(F.hex(octet.cast("int")), 2, "0"))
        groups = F.concat(pairs[0], pairs[1], F.lit(":"), pairs[2], pairs[3])
        head = F.substring(address, F.lit(1), F.length(address) - F.length(tail))
        return F.when(tail.contains("."), F.concat(head, F.lower(groups))).otherwise(address)

    def groups_of(text: Column) -> Column:
        return F.filter(F.split(text, ":"), lambda group: group != "")

    def fill(address: Column) -> Column:
        short = address.contains("::")
        left = groups_of(F.substring_index(address, "::", 1))
        right = F.when(short, groups_of(F.substring_index(address, "::", -1))).otherwise(F.array().cast("array<string>"))
        return _let(
            F.struct(left.alias("left"), right.alias("right")),
            lambda ends: F.concat(
                ends["left"],
                F.array_repeat(F.lit("0"), 8 - F.size(ends["left"]) - F.size(ends["right"])),
                ends["right"],
            ),
        )

    def spell_out(address: Column) -> Column:
        filled = _let(dotted_as_groups(address), fill)
        return F.array_join(F.transform(filled, lambda group: F.lpad(group, 4, "0")), "")

    return F.when(is_ipv6(ip), _let(F.lower(F.substring_index(ip, "%", 1)), spell_out))


def with_ipv4(df: DataFrame, ip: str, name: str) -> DataFrame:
    """Add an address column's IPv4 number, null where it is not a valid dotted address."""
    parts = F.when(F.col(ip).rlike(_IPV4), F.split(F.col(ip), r"\."))
    octets = [f"CAST(_parts[{i}] AS BIGINT) * {256 ** (3 - i)}" for i in range(4)]
    number = F.expr(" + ".join(octets))
    return df.withColumn("_parts", parts).withColumn(name, number).drop("_parts")


def direction_of(src_home: Column, dst_home: Column, both_valid: Column) -> Column:
    return (
        F.when(~(src_home | dst_home) | ~both_valid, "UNKNOWN")
        .when(src_home & dst_home, "INTERNAL")
        .when(src_home, "OUTBOUND")
        .when(dst_home, "INBOUND")
        .otherwise("UNKNOWN")
    )


def with_direction(df: DataFrame, networks: Sequence[str]) -> DataFrame:
    """Add the direction of each packet relative to a list of home networks.

    UNKNOWN where neither end is at home, where an address cannot be read, and
    everywhere when the list of networks itself cannot be read.
    """
    try:
        v4, v6 = parse_networks(networks)
    except ValueError:
        return df.withColumn("direction", F.lit("UNKNOWN"))
    out = with_ipv4(with_ipv4(df, "src_ip", "_src_v4"), "dst_ip", "_dst_v4")
    for end in ("src", "dst"):
        at_home = in_ranges(f"_{end}_v4", v4)
        if v6:
            out = out.withColumn(f"_{end}_v6", ipv6_hex(F.col(f"{end}_ip")))
            at_home = at_home | in_ranges(f"_{end}_v6", v6)
        out = out.withColumn(f"_{end}_home", at_home)
    # An end at home has been read already; only the other one is left to check.
    readable = {
        end: F.col(f"_{end}_home") | F.col(f"_{end}_v4").isNotNull() | is_ipv6(F.col(f"{end}_ip"))
        for end in ("src", "dst")
    }
    direction = direction_of(F.col("_src_home"), F.col("_dst_home"), readable["src"] & readable["dst"])
    helpers = [f"_{end}_{kind}" for end in ("src", "dst") for kind in ("v4", "v6", "home")]
    return out.withColumn("direction", direction).drop(*helpers)
