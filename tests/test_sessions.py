import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from model import track
from pyspark.sql import functions as F

from wiretide import ExtractionConfig
from wiretide.functions.flowkey import with_flow_identity
from wiretide.operators import flows
from wiretide.operators.layout import ARRIVAL_ORDER, FAN, INNER, TIME_ORDER, Layout, LayoutOptions, place, plan_layout, search_steps
from wiretide.operators.packets import capture_limit, split_valid
from wiretide.operators.running import running_totals
from wiretide.operators.sessions import scan_flows, with_flow_statistics
from wiretide.plans.extract import extract_features

T0 = 1_700_000_000_000_000
PACKET = (
    "packet_id long, src_ip string, dst_ip string, src_port int, dst_port int, protocol string, length long, ts_us long,"
    " tcp_flags string"
)
# Cuts even the smallest inputs.
FINE = LayoutOptions(rows_per_slice=7)


def packet(i, seconds, length=100, src="192.168.1.10", dst="8.8.8.8", sport=50000, dport=443, protocol="TCP", flags=None):
    return (i, src, dst, sport, dport, protocol, length, T0 + round(seconds * 1e6), flags)


def frame(spark, rows):
    return spark.createDataFrame(rows, PACKET)


def by_id(df):
    return {r.packet_id: r for r in df.collect()}


def test_single_udp_packet(spark):
    r = extract_features(frame(spark, [packet(1, 0, 70, sport=54321, dport=53, protocol="UDP")])).collect()[0]
    assert (r.direction, r.connection_state, r.total_packets_in_flow, r.inter_arrival_time) == ("OUTBOUND", "STATELESS", 1, None)
    assert (r.packet_rate, r.byte_rate, r.payload_size, r.avg_flow_time) == (1.0, 70.0, 42, 0.0)


def test_request_and_reply(spark):
    reply = packet(2, 0.1, src="8.8.8.8", dst="192.168.1.10", sport=443, dport=50000, flags="SA")
    out = by_id(extract_features(frame(spark, [packet(1, 0, flags="S"), reply])))
    assert out[1].flow_id == out[2].flow_id
    assert (out[1].connection_state, out[2].connection_state) == ("NEW", "ESTABLISHED")
    assert (out[1].direction, out[2].direction) == ("OUTBOUND", "INBOUND")
    assert out[2].total_packets_in_flow == 2
    assert out[2].inter_arrival_time == pytest.approx(0.1)


def test_flow_arithmetic(spark):
    r = by_id(extract_features(frame(spark, [packet(1, 100.0, 100), packet(2, 100.5, 200)])))[2]
    assert (r.total_bytes, r.flow_duration, r.avg_packet_size, r.packet_rate, r.byte_rate) == (300, 0.5, 150.0, 4.0, 600.0)


def test_expiry(spark):
    config = ExtractionConfig(flow_timeout_seconds=2.0)
    packets = frame(spark, [packet(1, 100.0), packet(2, 101.0)])
    now = T0 + 104_000_000
    assert flows.expired_flows(packets, now, config).count() == 1
    assert flows.active_flows(packets, now, config).count() == 0
    assert flows.active_flow_count(packets, now, config).first()[0] == 0
    # Idle for exactly the timeout is still tracked.
    assert flows.active_flow_count(packets, T0 + 103_000_000, config).first()[0] == 1
    assert flows.active_flows(packets, T0 + 103_000_000, config).count() == 1


def test_timeout_is_strict(spark):
    packets = frame(spark, [packet(1, 0), packet(2, 60.0), packet(3, 120.000001)])
    out = by_id(extract_features(packets))
    assert [out[i].total_packets_in_flow for i in (1, 2, 3)] == [1, 2, 1]
    assert out[3].inter_arrival_time is None


def test_no_flows(spark):
    empty = frame(spark, [])
    assert flows.mean_flow_time(flows.flow_summary(empty)).first() == (0, 0.0)
    assert extract_features(empty).count() == 0


def test_unusable_packets_are_set_aside(spark):
    rows = [packet(1, 0), packet(2, 1)[:1] + (None,) + packet(2, 1)[2:], packet(3, 2, length=None), packet(4, 3, src="bad")]
    good, bad = split_valid(frame(spark, rows))
    assert {r.packet_id: r.error for r in bad.collect()} == {2: "src_ip is missing", 3: "length is missing"}
    out = by_id(extract_features(frame(spark, rows)))
    # A row that cannot be used does not count; an address that cannot be read does.
    assert out[1].total_packets_in_flow == 1
    assert out[4].direction == "UNKNOWN"
    assert good.count() == 2


@st.composite
def traffic(draw):
    n = draw(st.integers(1, 60))
    clock, rows = 0, []
    for i in range(n):
        clock += draw(st.sampled_from([0, 0, 1, 500_000, 20_000_000, 59_999_999, 60_000_000, 60_000_001, 200_000_000]))
        # Half of all packets belong to one flow.
        client = draw(st.sampled_from([1, 1, 1, 2, 3, 4]))
        ends = (f"192.168.1.{client}", "8.8.8.8", 50000, 443)
        if draw(st.booleans()):
            ends = (ends[1], ends[0], ends[3], ends[2])
        rows.append((i, *ends, "TCP", draw(st.integers(20, 1500)), T0 + clock, draw(st.sampled_from(["S", "SA", "F", None]))))
    return rows


def modelled(rows, order):
    names = [c.split()[0] for c in PACKET.split(", ")]
    packets = [dict(zip(names, r)) for r in rows]
    for p in packets:
        p["flow"] = frozenset([p["src_ip"], p["dst_ip"]])
    return track(sorted(packets, key=lambda p: tuple(p[c] for c in order)), 60_000_000)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(traffic(), st.sampled_from([TIME_ORDER, ARRIVAL_ORDER]), st.randoms(use_true_random=False))
def test_scan_equals_the_model_cut_or_not(spark, rows, order, random):
    if order == ARRIVAL_ORDER:
        # Arrival with clocks that step back.
        rows = [r[:7] + (r[7] - random.choice([0, 0, 300_000, 70_000_000]),) + r[8:] for r in rows]
    packets = frame(spark, rows)
    expected = modelled(rows, order)
    for options in (LayoutOptions(), FINE):
        keyed = with_flow_identity(packets)
        layout = plan_layout(keyed, order, options)
        scanned = flows.add_avg_flow_time(scan_flows(keyed, 60_000_000, layout), layout)
        got = by_id(with_flow_statistics(scanned))
        for e in expected:
            r = got[e["packet_id"]]
            for name in ("session", "total_packets_in_flow", "total_bytes", "initiator_ip", "flow_duration", "packet_rate", "byte_rate", "inter_arrival_time"):
                assert r[name] == e[name], (name, options, r, e)
            assert r["avg_flow_time"] == pytest.approx(e["avg_flow_time"], rel=1e-12)
        if order == TIME_ORDER:
            timeline = by_id(flows.active_flow_timeline(packets, options=options))
            assert [timeline[e["packet_id"]].active_flows for e in expected] == [e["active"] for e in expected]


def busy_table(spark, n=4000):
    """One flow with two thirds of all packets and one instant with a third of them."""
    i = F.col("id")
    client = F.when(i % 3 < 2, 1).otherwise(2 + i % 50)
    shift = F.when((i > n // 3) & (i < 2 * n // 3), 0).otherwise((i * 7919) % 1_000_000 * 1000)
    return spark.range(n).select(
        i.alias("packet_id"),
        F.concat(F.lit("192.168.1."), client.cast("string")).alias("src_ip"),
        F.lit("8.8.8.8").alias("dst_ip"),
        F.lit(50000).alias("src_port"),
        F.lit(443).alias("dst_port"),
        F.lit("TCP").alias("protocol"),
        (20 + i % 1400).alias("length"),
        (F.lit(T0) + 500_000_000 + shift).alias("ts_us"),
        F.lit("A").alias("tcp_flags"),
    )


CUT = LayoutOptions(rows_per_slice=200)
# More slices than are cut at once: slices within slices.
NESTED = LayoutOptions(rows_per_slice=100, max_slices=4)


def test_layout_cuts_hot_flows_and_crowded_instants(spark):
    rows = with_flow_identity(busy_table(spark))
    layout = plan_layout(rows, options=CUT)
    assert len(layout.hot_flows) == 1 and len(layout.instants) == 1
    sliced = layout.with_slice(rows).cache()
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) <= layout.n_slices and max(sizes) < 3 * 200
    # Slices follow the order.
    ranges = sliced.groupBy("_slice").agg(F.min(F.struct("ts_us", "packet_id")).alias("a"), F.max(F.struct("ts_us", "packet_id")).alias("b")).orderBy("_slice").collect()
    assert all(x.b < y.a for x, y in zip(ranges, ranges[1:]))
    groups = layout.with_flow_slice(rows).groupBy("flow_id", "flow_slice").count()
    assert groups.agg(F.max("count")).first()[0] < 3 * 200
    assert plan_layout(rows).n_slices == 1


def test_slices_within_slices(spark):
    rows = with_flow_identity(busy_table(spark))
    layout = plan_layout(rows, options=NESTED)
    assert layout.inner is not None and layout.n_slices <= 2 * 4 and layout.hot_table.count() == 1
    slices = layout.with_slice(rows).groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.min(place(TIME_ORDER)).alias("a"), F.max(place(TIME_ORDER)).alias("b")).orderBy("_slice").collect()
    assert len(slices) >= rows.count() / 200 and max(x.n for x in slices) < 3 * 100
    assert all(x.b < y.a for x, y in zip(slices, slices[1:]))
    assert layout.with_flow_slice(rows).groupBy("flow_id", "flow_slice").count().agg(F.max("count")).first()[0] < 3 * 100


@pytest.mark.parametrize("fine", [CUT, NESTED], ids=["cut", "nested"])
@pytest.mark.parametrize("order", [TIME_ORDER, ARRIVAL_ORDER])
def test_cut_results_are_the_same_rows(spark, order, fine):
    table = busy_table(spark)

    def same(make):
        whole, cut = make(LayoutOptions()), make(fine)
        assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, cut.collect()), key=repr)

    same(lambda o: extract_features(table, order=order, options=o).drop("extra"))
    same(lambda o: flows.flow_summary(table, order=order, options=o))
    if order == TIME_ORDER:
        same(lambda o: flows.active_flow_timeline(table, options=o))
        now = T0 + 900_000_000
        same(lambda o: flows.active_flows(table, now, options=o))


@pytest.mark.parametrize("options", [CUT, NESTED], ids=["cut", "nested"])
def test_running_totals(spark, options):
    table = busy_table(spark, 1500)
    layout = plan_layout(table, options=options)
    assert layout.n_slices * layout.parts > 5
    got = running_totals(table, {"so_far": F.col("length")}, layout, {"so_far": 11})
    total = 11
    for r in sorted(got.collect(), key=lambda r: (r.ts_us, r.packet_id)):
        total += r.length
        assert r.so_far == total


def test_capture_limits(spark):
    table = busy_table(spark, 1500)
    for n in (1, 321, 1499, 2000):
        expected = [r.packet_id for r in table.orderBy("ts_us", "packet_id").limit(n).collect()]
        for options in (LayoutOptions(), CUT, NESTED):
            assert sorted(r.packet_id for r in capture_limit(table, n, options=options).collect()) == sorted(expected)
    assert capture_limit(table).count() == 1500
    first = table.agg(F.min("ts_us")).first()[0]
    early = capture_limit(table, timeout_seconds=100.0)
    assert early.count() == table.filter(F.col("ts_us") < first + 100_000_000).count() > 0


@pytest.mark.parametrize("cuts", [0, 1, 15, 16, 17, 255, 256, 1_000])
def test_a_place_is_found_among_many_cuts_by_a_few_comparisons(spark, cuts):
    inner = spark.range(2).selectExpr("cast(id AS int) AS _top", f"explode(sequence(0, {max(cuts - 1, 0)})) AS _i").filter(F.lit(cuts > 0))
    inner = inner.select("_top", "_i", F.struct((F.col("_i").cast("bigint") * 3 + F.col("_top") * 10_000).alias("ts_us"), F.lit(5).cast("bigint").alias("packet_id")).alias("_cut"))
    steps = search_steps(inner, cuts)
    assert all(table.agg(F.coalesce(F.max(F.size("_cuts")), F.lit(0))).first()[0] < FAN for _, table in steps)
    layout = Layout(cuts=(10_000,), inner=steps, parts=cuts + 1)
    rows = spark.range(0, 13_500, 7).selectExpr("id AS ts_us", "id % 10 AS packet_id")
    for r in layout.with_slice(rows).collect():
        top = int(r.ts_us >= 10_000)
        passed = sum((i * 3 + top * 10_000, 5) <= (r.ts_us, r.packet_id) for i in range(cuts))
        assert r._slice == top * INNER + passed
