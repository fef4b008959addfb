import hashlib
import ipaddress

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wiretide.functions import packets as pf
from wiretide.functions import text, threat
from wiretide.functions.flowkey import with_flow_identity
from wiretide.functions.netaddr import ipv6_hex, is_ipv6, with_direction, with_ipv4
from wiretide.operators import networks
from wiretide.operators.packets import with_metadata
from wiretide.schemas import DetectionConfig

PACKET = "packet_id long, src_ip string, dst_ip string, src_port int, dst_port int, protocol string, length long, ts_us long"


def values(df, column):
    return [r["v"] for r in df.select(column.alias("v")).collect()]


def test_protocol_and_ports(spark):
    df = spark.createDataFrame(
        [(["IP", "TCP"], 6), (["IP", "UDP"], 17), (["IP", "ICMP"], 1), (["IP"], 47), (["ICMP", "UDP", "TCP"], 6)], "layers array<string>, n int"
    )
    expected = ["TCP", "UDP", "ICMP", "OTHER", "TCP"]
    assert values(df, pf.protocol_from_layers(F.col("layers"))) == expected
    assert values(df, pf.protocol_from_number(F.col("n"))) == expected
    ports = spark.createDataFrame([("TCP", 80), ("UDP", 53), ("ICMP", 8), ("OTHER", 1)], "protocol string, port int")
    assert values(ports, pf.port_or_null(F.col("port"), F.col("protocol"))) == [80, 53, None, None]


def test_connection_state(spark):
    cases = [
        ("S", "NEW"), ("SA", "ESTABLISHED"), ("PA", "ESTABLISHED"), ("FA", "CLOSING"), ("R", "CLOSED"), ("RF", "CLOSED"),
        ("SEC", "UNKNOWN"), ("U", "UNKNOWN"), ("", "UNKNOWN"), (None, "UNKNOWN"), ("sa", "ESTABLISHED"), ("s", "NEW"),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "flags string")
    assert values(df, pf.connection_state(F.col("flags"), F.lit("TCP"))) == [c[1] for c in cases]
    assert set(values(df, pf.connection_state(F.col("flags"), F.lit("UDP")))) == {"STATELESS"}
    assert set(values(df, pf.connection_state(F.col("flags"), F.lit(None).cast("string")))) == {"STATELESS"}


def test_payload(spark):
    df = spark.createDataFrame([(100, "TCP"), (100, "UDP"), (20, "TCP"), (100, "ICMP"), (100, "OTHER"), (None, "TCP")], "n long, p string")
    assert values(df, pf.estimated_payload(F.col("n"), F.col("p"))) == [60, 72, 0, 72, 80, None]


def test_extra_fields_keep_a_present_null(spark):
    rows = [
        (1, 100, "TCP", {"payload_size": "7", "ttl": "64"}),
        (2, 100, "TCP", {"payload_size": None}),
        (3, 100, "TCP", {}),
        (4, 100, "TCP", None),
    ]
    df = spark.createDataFrame(rows, "packet_id long, length long, protocol string, extra map<string,string>")
    out = {r.packet_id: r for r in with_metadata(df).collect()}
    assert [out[i].payload_size for i in (1, 2, 3, 4)] == [7, None, 60, 60]
    assert [out[i].ttl for i in (1, 2, 3, 4)] == [64, None, None, None]


def test_flow_identity_is_the_same_both_ways(spark):
    rows = [
        (1, "192.168.1.10", "8.8.8.8", 54321, 53, "UDP", 70, 0),
        (2, "8.8.8.8", "192.168.1.10", 53, 54321, "UDP", 70, 0),
        (3, "10.0.0.1", "10.0.0.1", 9, 7, "TCP", 70, 0),
        (4, "10.0.0.1", "10.0.0.1", 7, 9, "TCP", 70, 0),
        (5, "10.0.0.1", "10.0.0.2", None, None, "ICMP", 70, 0),
    ]
    out = {r.packet_id: r for r in with_flow_identity(spark.createDataFrame(rows, PACKET), True).collect()}
    assert out[1].flow_id == out[2].flow_id and out[1].flow_hash == out[2].flow_hash
    assert out[3].flow_id == out[4].flow_id
    texts = {1: "UDP:192.168.1.10:54321<->8.8.8.8:53", 3: "TCP:10.0.0.1:7<->10.0.0.1:9", 5: "ICMP:10.0.0.1:0<->10.0.0.2:0"}
    for i, key in texts.items():
        assert out[i].flow_id == hashlib.sha256(key.encode()).hexdigest()[:16]


def directions(spark, pairs, nets):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "packet_id long, src_ip string, dst_ip string")
    return df, [r.direction for r in with_direction(df, nets).orderBy("packet_id").collect()]


def test_direction(spark):
    home = ["192.168.0.0/16", "10.0.0.0/8"]
    pairs = [
        ("192.168.1.5", "8.8.8.8"), ("8.8.8.8", "192.168.1.5"), ("192.168.1.5", "10.0.0.3"), ("8.8.8.8", "1.1.1.1"),
        ("not-an-ip", "192.168.1.5"), ("192.168.1.5", "256.1.1.1"), ("192.168.1.5", "2001:db8::1"), ("::1", "10.1.1.1"),
    ]
    expected = ["OUTBOUND", "INBOUND", "INTERNAL", "UNKNOWN", "UNKNOWN", "UNKNOWN", "OUTBOUND", "INBOUND"]
    assert directions(spark, pairs, home)[1] == expected
    assert set(directions(spark, pairs, ["10.0.0.0/99"])[1]) == {"UNKNOWN"}
    assert set(directions(spark, pairs, [])[1]) == {"UNKNOWN"}


ADDRESSES = [
    "::", "::1", "1::", "fe80::1%eth0", "fe80::1%", "fe80::1%a%b", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
    "1::8::9", ":::", "1:::2", "1:2:3:4:5:6:7:8:9", "::ffff:1.2.3.4", "::ffff:1.2.3.256", "1:2:3:4:5:6:1.2.3.4",
    "1:2:3:4:5:6:7:1.2.3.4", "12345::", "g::", ":1", "1:", "1::2:", "01.2.3.4", "1.2.3", "1.2.3.4", "256.1.1.1", "1.2.3.4\n",
    "", "1:2:3:4:5:6:7", "FE80::AbCd", "::%x", "1:2:3:4::5:6:7:8", "1:2:3::5:6:7:8", "::01.2.3.4", "0.0.0.0", "255.255.255.255",
]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["", "0", "ab", "FFFF", "12345", "1.2.3.4"]), min_size=1, max_size=10).map(":".join), min_size=200, max_size=200))
def test_addresses_read_as_in_the_standard_library(spark, made):
    texts = ADDRESSES + made
    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    out = with_ipv4(df, "ip", "v4").select("ip", "v4", ipv6_hex(F.col("ip")).alias("v6"), is_ipv6(F.col("ip")).alias("ok"))
    for r in out.collect():
        try:
            address = ipaddress.ip_address(r.ip)
        except ValueError:
            assert (r.v4, r.v6, r.ok) == (None, None, False), r.ip
            continue
        if address.version == 4:
            assert (r.v4, r.v6) == (int(address), None), r.ip
        else:
            assert (r.v4, r.v6, r.ok) == (None, f"{int(address):032x}", True), r.ip


NETWORKS = [f"10.{i}.{i % 7 * 32}.0/{19 + i % 9}" for i in range(0, 200, 3)] + ["2001:db8::/33", "fd00::/8", "fe80::/10"]


@pytest.mark.parametrize("how", ["list", "search", "join"])
def test_a_table_of_networks_gives_the_same_directions_as_a_list(spark, how, monkeypatch):
    pairs = [(f"10.{i}.{i * 5 % 256}.{i}", f"10.{i * 3 % 256}.{i % 7 * 32}.9") for i in range(0, 200, 2)]
    pairs += [("2001:db8::1", "2001:db8:8000::1"), ("fe80::1", "10.0.0.1"), ("10.0.0.1", "x"), ("fd12::9", "febf::1")]
    df, _ = directions(spark, pairs, [])
    nets = [ipaddress.ip_network(n, strict=False) for n in NETWORKS]

    def home(ip):
        address = ipaddress.ip_address(ip)
        return any(address in n for n in nets)

    expected = []
    for src, dst in pairs:
        try:
            s, d = home(src), home(dst)
        except ValueError:
            s = d = False
        expected.append("INTERNAL" if s and d else "OUTBOUND" if s else "INBOUND" if d else "UNKNOWN")
    table = spark.createDataFrame([(n,) for n in NETWORKS], "cidr string")
    monkeypatch.setattr(networks, "INLINE_NETWORKS", 1000 if how == "list" else 10)
    monkeypatch.setattr(networks, "LISTED_NETWORKS", 20 if how == "join" else 1000)
    got = networks.with_direction_by_table(df, table).orderBy("packet_id").collect()
    assert [r.direction for r in got] == expected
    assert {"INTERNAL", "OUTBOUND", "INBOUND", "UNKNOWN"} == set(expected)


def test_normalize_category(spark):
    cases = [
        ("ddos", "DDOS"), ("Port-Scan", "PORT_SCAN"), ("Unknown_Category_XYZ", "UNKNOWN"), (" Brute Force\t", "BRUTE_FORCE"),
        ("", "UNKNOWN"), (None, "UNKNOWN"), ("data-exfiltration\n", "DATA_EXFILTRATION"), ("brute  force", "UNKNOWN"),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "raw string")
    assert values(df, threat.normalize_category(F.col("raw"))) == [c[1] for c in cases]


def test_severity(spark):
    cases = [
        (10.0, "LOW"), (30.0, "LOW"), (50.0, "MEDIUM"), (70.0, "MEDIUM"), (80.0, "HIGH"), (90.0, "HIGH"), (95.0, "CRITICAL"),
        (-5.0, "LOW"), (30.5, "MEDIUM"), (100.1, "CRITICAL"), (None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "c double")
    assert values(df, threat.severity(F.col("c"))) == [c[1] for c in cases]
    short = DetectionConfig(severity_bands=(("LOW", 30.0),))
    assert values(df.limit(3), threat.severity(F.col("c"), short)) == ["LOW", "LOW", "CRITICAL"]


def test_threat_label_and_risk(spark):
    rows = [("BENIGN", 99.0), ("UNKNOWN", 50.0), ("PORT_SCAN", 30.0), ("PORT_SCAN", 80.0), ("PORT_SCAN", 50.0)]
    df = spark.createDataFrame(rows, "category string, c double")
    assert values(df, threat.threat_label(F.col("category"), F.col("c"))) == ["BENIGN", "UNKNOWN", "SUSPICIOUS", "MALICIOUS", "MALICIOUS"]
    risks = spark.createDataFrame([("DATA_EXFILTRATION", 90.0), ("PORT_SCAN", 90.0), ("BENIGN", 90.0), ("other", 90.0), ("DDOS", 200.0)], "category string, c double")
    assert values(risks, threat.risk_score(F.col("category"), F.col("c"))) == pytest.approx([85.5, 49.5, 0.0, 45.0, 90.0])


def test_texts(spark):
    row = (1, "10.0.0.1", "10.0.0.2", None, 53, "UDP", 70, 1704067211172400)
    df = spark.createDataFrame([row], PACKET)
    assert values(df, text.packet_summary()) == ["[UDP] 10.0.0.1:None -> 10.0.0.2:53 len=70 ts=1704067211.1724"]
    micros = [7000000, 100500000, 1, 1704067200000000, 1704067211172425]
    ts = spark.createDataFrame([(m,) for m in micros], "t long")
    assert values(ts, text.seconds_text(F.col("t"))) == ["7.0", "100.5", "0.000001", "1704067200.0", "1704067211.172425"]
    json = text.as_json(df.select("packet_id", "src_port")).collect()[0]["value"]
    assert json == '{"packet_id":1,"src_port":null}'
