"""Membership of addresses in a table of networks, for lists too long to write into an expression."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from wiretide.functions.netaddr import direction_of, ipv6_hex, is_ipv6, parse_networks, with_direction, with_ipv4

# Up to this many networks their merged ranges are looked up by binary search.
LISTED_NETWORKS = 100_000
# Up to this many they are plain comparisons in the generated code.
INLINE_NETWORKS = 32


def with_direction_by_table(packets: DataFrame, networks: DataFrame, column: str = "cidr") -> DataFrame:
    """Add each packet's direction relative to the networks of a table.

    Every network is read first, where the table lies: as for a list, one that
    cannot be read makes every direction UNKNOWN, however many there are. Their
    number then only chooses how addresses are looked up. A long IPv4 list becomes
    one sorted list of range ends and each address is placed in it by binary search,
    so the packets are neither joined nor shuffled. Beyond ``LISTED_NETWORKS``, or
    with many IPv6 networks, the distinct addresses are joined with the networks.
    """
    distinct = networks.select(F.col(column).alias("cidr")).distinct()
    read = distinct.withColumn("_read", _network_digits(F.col("cidr")))
    total, unreadable, wide = read.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("_read").isNull()),
        F.count_if(F.col("_read").startswith("6")),
    ).first()
    if unreadable:
        return packets.withColumn("direction", F.lit("UNKNOWN"))
    if total > LISTED_NETWORKS or wide > INLINE_NETWORKS < total:
        return _by_join(packets, read.select("_read"))
    found = [r["cidr"] for r in distinct.collect()]
    if len(found) <= INLINE_NETWORKS:
        return with_direction(packets, found)
    v4, v6 = parse_networks(found)
    out = with_ipv4(with_ipv4(packets, "src_ip", "_src_v4"), "dst_ip", "_dst_v4")
    for end in ("src", "dst"):
        # Ranges do not touch, so bucket numbers are odd exactly inside a range.
        ends = [float(x) for low, high in v4 for x in (low, high + 1)]
        inside = F.lit(False)
        if ends:
            place = Bucketizer(
                splits=[float("-inf"), *ends, float("inf")],
                inputCol="_place",
                outputCol="_bucket",
                handleInvalid="keep",
            )
            number = F.coalesce(F.col(f"_{end}_v4").cast("double"), F.lit(-1.0))
            out = place.transform(out.withColumn("_place", number))
            inside = F.col("_bucket") % 2 == 1
        if v6:
            out = out.withColumn("_hex", ipv6_hex(F.col(f"{end}_ip")))
            for low, high in v6:
                inside = inside | F.coalesce(F.col("_hex").between(low, high), F.lit(False))
        out = out.withColumn(f"_{end}_home", inside).drop("_place", "_bucket", "_hex")
    valid = {
        end: F.col(f"_{end}_v4").isNotNull() | is_ipv6(F.col(f"{end}_ip")) for end in ("src", "dst")
    }
    direction = direction_of(F.col("_src_home"), F.col("_dst_home"), valid["src"] & valid["dst"])
    return out.withColumn("direction", direction).drop("_src_v4", "_dst_v4", "_src_home", "_dst_home")


def _hex_digits(df: DataFrame, ip: str, name: str) -> DataFrame:
    """Either kind of address as hex digits behind its kind: 4 and 8 digits, or 6 and 32."""
    v4 = F.concat(F.lit("4"), F.lower(F.lpad(F.hex(F.col("_v4")), 8, "0")))
    return with_ipv4(df, ip, "_v4").withColumn(name, F.coalesce(v4, F.concat(F.lit("6"), ipv6_hex(F.col(ip))))).drop("_v4")


def _network_digits(cidr: Column) -> Column:
    """A network as the digits of its base behind its kind, and its bits: "40a000000/8"; null if unreadable.

    The column is one of networks, never of packets, so Python costs little here and
    reads a network exactly as it is read from a list.
    """

    def read(text: str | None) -> str | None:
        try:
            network = ipaddress.ip_network(text, strict=False)
        except ValueError:
            return None
        base = f"{int(network.network_address):0{network.max_prefixlen // 4}x}"
        return f"{network.version}{base}/{network.prefixlen}"

    @F.pandas_udf(StringType())
    def digits(texts: pd.Series) -> pd.Series:
        return texts.map(read)

    return digits(cidr)


def _prefixes(networks: DataFrame) -> DataFrame:
    """Every network as the hex prefixes it consists of, at most eight each."""
    digits = networks.select(
        F.split_part("_read", F.lit("/"), F.lit(1)).alias("_digits"),
        F.split_part("_read", F.lit("/"), F.lit(2)).cast("int").alias("_bits"),
    )
    whole = F.floor(F.col("_bits") / 4).cast("int")
    spare = F.when(F.col("_bits") % 4 == 0, 0).otherwise(4 - F.col("_bits") % 4).cast("int")
    digits = digits.withColumns({"_whole": whole, "_spare": spare})
    # The digit that the prefix length cuts through runs over all values of its free bits.
    digit = F.conv(F.substring(F.col("_digits"), F.col("_whole") + 2, F.lit(1)), 16, 10).cast("int")
    span = F.expr("shiftleft(1, _spare)")
    first = digit - digit % span
    fixed = F.substring(F.col("_digits"), F.lit(1), F.col("_whole") + 1)
    parts = F.when(F.col("_spare") == 0, F.array(fixed)).otherwise(
        F.transform(F.sequence(first, first + span - 1), lambda d: F.concat(fixed, F.lower(F.hex(d))))
    )
    return digits.select(F.explode(parts).alias("_prefix")).distinct()


def _by_join(packets: DataFrame, networks: DataFrame) -> DataFrame:
    """Join distinct addresses with the networks by prefix, then packets with the addresses at home.

    In the second join every address stands once on its side, so adaptive execution can
    split the packets of a busy address over as many tasks as their size asks for.
    """
    prefixes = _prefixes(networks)
    lengths = [r[0] for r in prefixes.select(F.length("_prefix")).distinct().limit(42).collect()]
    ends = packets.select(F.explode(F.array("src_ip", "dst_ip")).alias("ip")).distinct()
    candidates = _hex_digits(ends, "ip", "_digits").withColumn(
        "_prefix", F.explode(F.array(*[F.substring("_digits", 1, n) for n in lengths]))
    )
    at_home = candidates.join(prefixes, "_prefix", "left_semi").select("ip").distinct()
    out = packets
    for end in ("src", "dst"):
        side = at_home.select(F.col("ip").alias(f"{end}_ip"), F.lit(True).alias(f"_{end}_home"))
        out = out.join(side, f"{end}_ip", "left")
    out = with_ipv4(with_ipv4(out, "src_ip", "_src_v4"), "dst_ip", "_dst_v4")
    home = {end: F.coalesce(F.col(f"_{end}_home"), F.lit(False)) for end in ("src", "dst")}
    valid = {end: F.col(f"_{end}_v4").isNotNull() | is_ipv6(F.col(f"{end}_ip")) for end in ("src", "dst")}
    direction = direction_of(home["src"], home["dst"], valid["src"] & valid["dst"])
    return out.select(*packets.columns, direction.alias("direction"))
