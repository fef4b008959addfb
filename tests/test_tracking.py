import numpy as np
import pytest
from test_sessions import CUT, T0, busy_table

from wiretide.functions.flowkey import with_flow_identity
from wiretide.operators import flows, tracking
from wiretide.operators.layout import ARRIVAL_ORDER, Layout, LayoutOptions, plan_layout
from wiretide.operators.packets import split_valid
from wiretide.plans.extract import extract_features
from wiretide.schemas import MICROS, ExtractionConfig
from wiretide.streaming.flows import stream_features

FINE = LayoutOptions(rows_per_slice=15)
NESTED = LayoutOptions(rows_per_slice=15, max_slices=3)


def track(packets, timeout_us, interval_us=0, capacity=None):
    """Session numbers of flows kept in a table, one packet after the other: sweeps first, then room is made, then the flow is found."""
    live, sessions, swept, out = {}, {}, -(10**18), {}
    for number, ts, flow in packets:
        if ts - swept >= interval_us:
            swept = ts
            live = {f: seen for f, seen in live.items() if ts - seen[0] <= timeout_us}
        if flow not in live:
            if capacity is not None and len(live) >= capacity:
                # Of flows seen at one instant the one whose packet came first goes first.
                del live[min(live, key=live.get)]
            sessions[flow] = sessions.get(flow, 0) + 1
        live[flow] = (ts, number)
        out[number] = sessions[flow]
    return out


@pytest.fixture(scope="module")
def table(spark):
    return busy_table(spark, 900).cache()


@pytest.mark.parametrize("options", [LayoutOptions(), CUT, FINE, NESTED], ids=["whole", "cut", "fine", "nested"])
@pytest.mark.parametrize("interval, capacity", [(5.0, None), (37.3, None), (None, 3), (None, 12), (20.0, 6)])
def test_sessions_under_sweeps_and_a_cap(spark, table, options, interval, capacity):
    rows = with_flow_identity(split_valid(table)[0])
    config = ExtractionConfig(cleanup_interval_seconds=interval, max_tracked_flows=capacity)
    scanned = tracking.scan(rows, config, plan_layout(rows, options=options))
    packets = [(r.packet_id, r.ts_us, r.flow_id) for r in rows.orderBy("ts_us", "packet_id").select("packet_id", "ts_us", "flow_id").collect()]
    want = track(packets, config.timeout_us, round((interval or 0) * MICROS), capacity)
    got = {r.packet_id: r.session for r in scanned.select("packet_id", "session").collect()}
    assert got == want and want != track(packets, config.timeout_us)


def test_sweeps_over_slices_shorter_than_an_interval(spark):
    # Many slices within one interval, long silences, and groups of slices at several levels.
    rng = np.random.default_rng(6)
    steps = rng.choice([0, 1, 400_000, 1_700_000, 9_000_000, 80_000_000], 400, p=[0.3, 0.2, 0.3, 0.15, 0.04, 0.01])
    times = T0 + np.cumsum(steps)
    rows = spark.createDataFrame([(i, int(t)) for i, t in enumerate(times)], "packet_id long, ts_us long")
    swept, want = -(10**18), {}
    for i, t in enumerate(times.tolist()):
        swept = t if t - swept >= 5_000_000 else swept
        want[i] = swept
    for size, cut in ((7, 2), (30, 3), (1_000, 8)):
        layout = plan_layout(rows, options=LayoutOptions(rows_per_slice=size))
        got = tracking.with_last_sweep(rows, 5_000_000, layout, cut)
        assert {r.packet_id: r._swept_us for r in got.collect()} == want, (size, cut)


def test_counting_what_is_greater_before():
    rng = np.random.default_rng(1)
    for n, k in ((0, 1), (1, 1), (7, 2), (200, 9), (200, 10**12)):
        v = rng.integers(-k, k + 1, n)
        assert tracking.earlier_greater(v).tolist() == [int((v[:i] > v[i]).sum()) for i in range(n)]


def test_settings_reach_features_and_summaries_and_not_streams(spark, table, tmp_path):
    config = ExtractionConfig(max_tracked_flows=3)
    features = extract_features(table, config, options=CUT)
    summary = flows.flow_summary(table, config)
    assert features.filter("total_packets_in_flow = 1").count() == summary.count() > flows.flow_summary(table).count()
    assert features.count() == extract_features(table).count()
    with pytest.raises(ValueError, match="stream"):
        stream_features(table, str(tmp_path), print, config=config)
    with pytest.raises(ValueError, match="order of time"):
        tracking.with_last_sweep(table, 5, Layout(ARRIVAL_ORDER))
    assert tracking.scan(with_flow_identity(table.limit(0)), ExtractionConfig(cleanup_interval_seconds=5.0, max_tracked_flows=2)).count() == 0
