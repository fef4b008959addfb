"""Flow breaks that depend on other flows' packets: a cap on tracked flows, and sweeps at intervals.

Both follow from the packets alone, without keeping a table of flows:

* With room for C flows, a new one displaces the flow seen longest ago. So a flow is lost
  between two of its packets exactly if C other flows were seen in between. The flows seen
  between packets a and b are the packets there less those that have their flow's next
  packet there too, which is a count of nested intervals. It is made of counts within
  slices, by the slice of b and by the slice of a, and of counts per pair of slices.
* Where idle flows are only looked for by sweeps, at least an interval apart, a flow ends
  between two packets exactly if the last sweep up to the later one comes more than the
  timeout after the earlier one. A slice maps the last sweep before it to the last one in
  it; these maps are composed in groups of slices, level by level, and then read back.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretide.functions.flowkey import FLOW_KEYS
from wiretide.operators.layout import Layout
from wiretide.operators.running import running_totals
from wiretide.operators.sessions import scan_flows
from wiretide.schemas import MICROS, ExtractionConfig
from wiretide.sources.package import ship_package
from wiretide.sources.storage import materialize

#: Slices whose maps are composed at once.
GROUP = 8
#: Before all times, and a timeout beyond all of them.
NEVER, FOREVER = -(2**62), 2**61


def with_previous(rows: DataFrame, layout: Layout) -> DataFrame:
    """Adds a packet's number in the whole order (``_at``, from 1) and slice (``_j``), and the same and the time of its flow's previous packet (``_before``, ``_i``, ``_before_us``)."""
    numbered = layout.top().with_slice(running_totals(rows, {"_at": F.lit(1).cast("bigint")}, layout), "_j")
    keys = [*FLOW_KEYS, "flow_slice"]
    sliced = layout.with_flow_slice(numbered) if layout.cuts_flows else numbered.withColumn("flow_slice", F.lit(-1))
    names = {"_before": "_at", "_i": "_j", "_before_us": "ts_us"}
    along = Window.partitionBy(*keys).orderBy("_at")
    out = sliced.withColumns({new: F.lag(c).over(along) for new, c in names.items()})
    if layout.cuts_flows:
        ends = sliced.filter("flow_slice >= 0").groupBy(*keys).agg(*[F.max_by(c, "_at").alias(f"{new}_carried") for new, c in names.items()])
        earlier = Window.partitionBy(*FLOW_KEYS).orderBy("flow_slice")
        ends = ends.select(*keys, *[F.lag(f"{new}_carried").over(earlier).alias(f"{new}_carried") for new in names])
        out = out.join(ends, keys, "left").withColumns({new: F.coalesce(new, f"{new}_carried") for new in names})
    return out.drop("flow_slice", *[f"{new}_carried" for new in names])


# Capacity


def earlier_greater(values: np.ndarray) -> np.ndarray:
    """For each entry, how many before it are greater: bit by bit, entries with equal leading bits kept in order."""
    _, values = np.unique(values, return_inverse=True)
    n, counts, order = len(values), np.zeros(len(values), dtype=np.int64), np.arange(len(values))
    for bit in range(int(values.max(initial=0)).bit_length() - 1, -1, -1):
        own = values[order]
        ones = (own >> bit) & 1
        before = np.cumsum(ones) - ones
        head = np.concatenate([[True], own[1:] >> (bit + 1) != own[:-1] >> (bit + 1)]) if n else np.zeros(0, dtype=bool)
        before = before - before[np.flatnonzero(head)][np.cumsum(head) - 1]
        counts[order[ones == 0]] += before[ones == 0]
        order = order[np.argsort(own >> bit, kind="stable")]
    return counts


def _counter(by: str, value: str, name: str, reverse: bool = False):
    """For a group of rows, taken by one column: how many before each have a greater value; reversed, how many a smaller one, from the last."""

    def count(table: pa.Table) -> pa.Table:
        sign = -1 if reverse else 1
        order = np.argsort(sign * table.column(by).to_numpy(), kind="stable")
        found = np.empty(len(order), dtype=np.int64)
        found[order] = earlier_greater(sign * table.column(value).to_numpy()[order])
        return pa.table({"_at": table.column("_at"), name: found})

    return count


def with_evictions(rows: DataFrame, capacity: int, alive: Column) -> DataFrame:
    """Adds ``_evicted``: whether so many other flows were seen since the flow's previous packet.

    rows: as ``with_previous`` gives them. Only packets whose flow is else ``alive`` are
    asked for, but all count as packets of other flows. A task holds the intervals that end,
    or start, in one slice.
    """
    ship_package(rows.sparkSession)
    columns = ["_at", "_before", F.col("_i").cast("bigint").alias("_i"), F.col("_j").cast("bigint").alias("_j"), alive.alias("_alive")]
    points = materialize(rows.filter(F.col("_before").isNotNull()).select(*columns), "intervals")
    asked = points.filter((F.col("_at") - F.col("_before") > capacity) & F.col("_alive"))
    pairs = [(r["_i"], r["_j"]) for r in asked.select("_i", "_j").distinct().collect()]
    if not pairs:
        return rows.withColumn("_evicted", F.lit(False))
    # In the slice of the later packet: intervals that end before it and start after its own start.
    same_end = points.groupBy("_j").applyInArrow(_counter("_at", "_before", "_nested_a"), "_at long, _nested_a long")
    # In the slice of the earlier packet: intervals that start after it and end in a slice before the later one's.
    same_start = points.groupBy("_i").applyInArrow(_counter("_before", "_j", "_nested_b", reverse=True), "_at long, _nested_b long")
    # Between the two: intervals that lie wholly there. Only pairs of slices as near as those asked for matter.
    reach = max(j - i for i, j in pairs)
    near = points.filter(F.col("_j") - F.col("_i") <= reach).groupBy("_i", "_j").agg(F.count(F.lit(1)).alias("n")).collect()
    between = rows.sparkSession.createDataFrame(_between(pairs, [tuple(r) for r in near]), "_i long, _j long, _nested_c long")
    counted = asked.join(same_end, "_at").join(same_start, "_at").join(between, ["_i", "_j"])
    others = F.col("_at") - F.col("_before") - 1 - F.col("_nested_a") - F.col("_nested_b") - F.col("_nested_c")
    lost = counted.filter(others >= capacity).select("_at", F.lit(True).alias("_evicted"))
    return rows.join(lost, "_at", "left").withColumn("_evicted", F.coalesce("_evicted", F.lit(False)))


def _between(pairs: list[tuple[int, int]], counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Per pair (i, j) the intervals that lie within slices i + 1 to j - 1."""
    starts, wanted = defaultdict(list), defaultdict(set)
    for i, j, n in counts:
        starts[i].append((j, n))
    for i, j in pairs:
        wanted[j].add(i)
    out = []
    for j, of in wanted.items():
        inside = 0
        for i in range(j, min(of) - 1, -1):
            if i in of:
                out.append((i, j, inside))
            inside += sum(n for end, n in starts[i] if end < j)
    return out


# Sweeps


def _next_sweeps(times: np.ndarray, interval: int) -> np.ndarray:
    """For a sweep at each of the sorted times, the last sweep of the chain that follows from it."""
    following = np.searchsorted(times, times + interval)
    last = np.where(following < len(times), following, np.arange(len(times)))
    while True:
        further = last[last]
        if (further == last).all():
            return times[last]
        last = further


def _apply(sweeps: np.ndarray, starts: np.ndarray, ends: np.ndarray, interval: int) -> np.ndarray:
    """The last sweeps after a slice, from those before it; a slice none reaches leaves them as they are."""
    at = np.searchsorted(starts, np.where(sweeps == NEVER, NEVER, sweeps + interval))
    return np.where(at < len(starts), ends[np.minimum(at, len(starts) - 1)], sweeps)


def _unpack(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    return [(r["part"], np.frombuffer(r["starts"], "<i8"), np.frombuffer(r["ends"], "<i8")) for r in rows]


_MAP = "part long, starts binary, ends binary"
_MAP_ARROW = pa.schema([("part", pa.int64()), ("starts", pa.binary()), ("ends", pa.binary())])


def with_last_sweep(rows: DataFrame, interval_us: int, layout: Layout, cut: int = GROUP) -> DataFrame:
    """Adds ``_swept_us``: the time of the last sweep up to a packet, its own included; the first packet sweeps.

    The packets are taken in order of time. A slice's map holds the times of its first
    interval and the one after, the only ones at which a chain of sweeps can enter it.
    """
    ship_package(rows.sparkSession)
    if layout.order[0] != "ts_us":
        raise ValueError("sweeps need packets in order of time")
    # A sweep is at a time, so equal times go together.
    whole = Layout(layout.order[:1], layout.cuts)
    times = whole.with_slice(rows.select("ts_us").distinct(), "_part").select("ts_us", F.col("_part").cast("bigint").alias("_part"))
    times = materialize(times, "times")

    def chart(table: pa.Table) -> pa.Table:
        t = np.sort(table.column("ts_us").to_numpy())
        ends = _next_sweeps(t, interval_us)
        enter = min(int(np.searchsorted(t, t[0] + interval_us)) + 1, len(t))
        part = table.column("_part")[0].as_py()
        return pa.table({"part": [part], "starts": [t[:enter].astype("<i8").tobytes()], "ends": [ends[:enter].astype("<i8").tobytes()]}, schema=_MAP_ARROW)

    levels = [materialize(times.groupBy("_part").applyInArrow(chart, _MAP), "sweep-maps")]

    def compose(table: pa.Table) -> pa.Table:
        maps = _unpack(table)
        part, starts, ends = maps[0]
        for _, s, e in maps[1:]:
            ends = _apply(ends, s, e, interval_us)
        # Where the first part is shorter than an interval, a chain may also enter at one of the next.
        all_starts, all_ends = [starts], [ends]
        for k, (_, s, after) in enumerate(maps[1:], start=1):
            if all_starts[-1][-1] >= starts[0] + interval_us:
                break
            for _, s2, e2 in maps[k + 1 :]:
                after = _apply(after, s2, e2, interval_us)
            all_starts.append(s)
            all_ends.append(after)
        starts, ends = np.concatenate(all_starts), np.concatenate(all_ends)
        return pa.table({"part": [part // cut], "starts": [starts.astype("<i8").tobytes()], "ends": [ends.astype("<i8").tobytes()]}, schema=_MAP_ARROW)

    group, n = F.floor(F.col("part") / cut).cast("bigint").alias("group"), whole.n_slices
    while n > cut:
        levels.append(materialize(levels[-1].groupBy(group).applyInArrow(compose, _MAP), "sweep-maps"))
        n = -(-n // cut)

    def read_back(key: tuple, table: pa.Table) -> pa.Table:
        sweep = np.array([table.column("before")[0].as_py()], dtype=np.int64)
        parts, before = [], []
        for part, starts, ends in _unpack(table):
            parts.append(part)
            before.append(int(sweep[0]))
            sweep = _apply(sweep, starts, ends, interval_us)
        return pa.table({"part": pa.array(parts, pa.int64()), "before": pa.array(before, pa.int64())})

    entry = None
    for maps in reversed(levels):
        grouped = maps.select(group, "*")
        if entry is None:
            grouped = grouped.withColumn("group", F.lit(0).cast("bigint")).withColumn("before", F.lit(NEVER).cast("bigint"))
        else:
            grouped = grouped.join(entry.withColumnRenamed("part", "group"), "group")
        entry = materialize(grouped.groupBy("group").applyInArrow(read_back, "part long, before long"), "sweeps-before")

    def sweep(table: pa.Table) -> pa.Table:
        t = np.sort(table.column("ts_us").to_numpy())
        last, out = table.column("before")[0].as_py(), []
        at = int(np.searchsorted(t, NEVER if last == NEVER else last + interval_us))
        while at < len(t):
            out.append(at)
            at = int(np.searchsorted(t, t[at] + interval_us))
        upto = np.searchsorted(np.array(out, dtype=np.int64), np.arange(len(t)), side="right")
        seen = np.concatenate([[last], t[np.array(out, dtype=np.int64)]]) if out else np.array([last])
        return pa.table({"ts_us": t, "_swept_us": seen[upto]})

    swept = times.join(entry.withColumnRenamed("part", "_part"), "_part").groupBy("_part").applyInArrow(sweep, "ts_us long, _swept_us long")
    return rows.join(swept, "ts_us")


def scan(rows: DataFrame, config: ExtractionConfig, layout: Layout = Layout()) -> DataFrame:
    """The flow scan under all settings that make a flow end: timeout, sweeps and room."""
    if config.cleanup_interval_seconds is None and config.max_tracked_flows is None:
        return scan_flows(rows, config.timeout_us, layout)
    rows, timeout, over = with_previous(rows, layout), config.timeout_us, F.lit(False)
    gap = F.col("ts_us") - F.col("_before_us")
    if config.cleanup_interval_seconds is not None:
        rows = with_last_sweep(rows, round(config.cleanup_interval_seconds * MICROS), layout)
        over, timeout = F.coalesce(F.col("_swept_us") - F.col("_before_us") > timeout, F.lit(False)), FOREVER
    if config.max_tracked_flows is not None:
        alive = ~over & (gap <= timeout)
        rows = with_evictions(rows, config.max_tracked_flows, alive)
        over = over | F.col("_evicted")
    # Written once: a flow scan reads its rows twice where hot flows are cut.
    rows = materialize(rows.withColumn("_forced", over), "tracked") if layout.cuts_flows else rows.withColumn("_forced", over)
    helpers = ("_at", "_j", "_before", "_i", "_before_us", "_swept_us", "_evicted")
    return scan_flows(rows.drop(*helpers), timeout, layout).drop("_forced")
