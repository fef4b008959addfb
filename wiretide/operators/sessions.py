"""Running per-flow state: one row per packet with what its flow looks like so far.

A flow's packets are split into incarnations ("sessions") wherever it was idle
for longer than the timeout. All columns come from windows that share one
partitioning and one order, so the packets are shuffled once and sorted once.

A hot flow is cut along the slices of the layout. Each of its slices is then
scanned by a task of its own, starting from what the earlier slices leave
behind, which a small table of one row per (flow, slice) tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretide.functions.flowkey import FLOW_KEYS
from wiretide.operators.layout import Layout
from wiretide.schemas import MICROS

SLICE_KEYS = (*FLOW_KEYS, "flow_slice")
# State a flow carries from one slice, or one micro-batch, into the next.
CARRY_COLUMNS = ("last_us", "packets", "bytes", "start_us", "initiator_ip", "sessions")
BEFORE_ALL_SLICES = -2


def _running(keys, order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _gap(ts: Column, previous: Column, timeout_us: int) -> Column:
    """Idle for longer than the timeout; exactly the timeout is not yet a break."""
    return (ts - previous) > timeout_us


def summarize_slices(rows: DataFrame, order: tuple[str, ...], timeout_us: int) -> DataFrame:
    """One row per (flow, slice): its ends, its breaks, and its last session so far."""
    by_order = Window.partitionBy(*SLICE_KEYS).orderBy(*order)
    run = _running(SLICE_KEYS, order)
    ts, forced = F.col("ts_us"), "_forced" in rows.columns
    breaks = _gap(ts, F.col("_previous"), timeout_us)
    # The slice's own first packet breaks nothing within the slice.
    breaks = (F.col("_previous").isNotNull() & (breaks | F.col("_forced"))) if forced else breaks
    local = (
        rows.select(*SLICE_KEYS, *dict.fromkeys(("ts_us", *order)), "length", "src_ip", *["_forced"][: int(forced)])
        .withColumn("_previous", F.lag("ts_us").over(by_order))
        .withColumn("_n", F.row_number().over(by_order).cast("bigint"))
        .withColumn("_bytes", F.sum("length").over(run))
        .withColumn("_break", F.coalesce(breaks, F.lit(False)))
    )
    opening = F.struct(
        (F.col("_n") - 1).alias("n"), (F.col("_bytes") - F.col("length")).alias("bytes"), "ts_us", "src_ip"
    )
    grouped = local.groupBy(*SLICE_KEYS).agg(
        F.min_by("ts_us", "_n").alias("first_us"),
        F.max_by("ts_us", "_n").alias("last_us"),
        F.count(F.lit(1)).alias("_rows"),
        F.sum("length").alias("_length"),
        F.sum(F.col("_break").cast("bigint")).alias("breaks"),
        F.min_by(F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("bytes"), "ts_us", "src_ip"), "_n").alias("_opening"),
        F.max_by(opening, F.when(F.col("_break"), F.col("_n"))).alias("_reopening"),
        (F.min_by("_forced", "_n") if forced else F.lit(False)).alias("first_forced"),
    )
    tail = F.coalesce(F.col("_reopening"), F.col("_opening"))
    return grouped.select(
        *SLICE_KEYS,
        "first_us",
        "last_us",
        "first_forced",
        "breaks",
        (F.col("_rows") - tail["n"]).alias("tail_packets"),
        (F.col("_length") - tail["bytes"]).alias("tail_bytes"),
        tail["ts_us"].alias("tail_start_us"),
        tail["src_ip"].alias("tail_initiator"),
    )


def state_as_slices(state: DataFrame) -> DataFrame:
    """Earlier flow state as the summary of a slice that lies before all others."""
    return state.select(
        *FLOW_KEYS,
        F.lit(BEFORE_ALL_SLICES).alias("flow_slice"),
        F.col("start_us").alias("first_us"),
        "last_us",
        F.lit(False).alias("first_forced"),
        # The slice's own opening counts as one more.
        (F.col("sessions") - 1).alias("breaks"),
        F.col("packets").alias("tail_packets"),
        F.col("bytes").alias("tail_bytes"),
        F.col("start_us").alias("tail_start_us"),
        F.col("initiator_ip").alias("tail_initiator"),
    )


def state_as_rows(state: DataFrame) -> DataFrame:
    """Earlier flow state as one row before all packets of its flow, which stands for all it has had."""
    return state.select(
        *FLOW_KEYS,
        F.col("last_us").alias("ts_us"),
        F.col("bytes").alias("length"),
        F.col("packets").alias("_weight"),
        F.col("sessions").alias("_sessions"),
        F.col("start_us").alias("_start_us"),
        F.col("initiator_ip").alias("src_ip"),
        F.lit(0).cast("bigint").alias("_rank"),
    )


def carry_into_slices(summaries: DataFrame, timeout_us: int) -> DataFrame:
    """What each (flow, slice) finds around it: the state after the slices before, and the next packet."""
    along = Window.partitionBy(*FLOW_KEYS).orderBy("flow_slice")
    run = _running(FLOW_KEYS, ["flow_slice"])
    opened = F.coalesce(_gap(F.col("first_us"), F.col("_previous"), timeout_us) | F.col("first_forced"), F.lit(True))
    in_episode = _running((*FLOW_KEYS, "_episode"), ["flow_slice"])
    after = (
        summaries.withColumn("_previous", F.lag("last_us").over(along))
        .withColumn("_opened", F.col("breaks") + opened.cast("bigint"))
        .withColumn("sessions", F.sum("_opened").over(run))
        # Slices that share the session left open by the first of them.
        .withColumn("_episode", F.sum((F.col("_opened") > 0).cast("bigint")).over(run))
        .withColumn("packets", F.sum("tail_packets").over(in_episode))
        .withColumn("bytes", F.sum("tail_bytes").over(in_episode))
        .withColumn("start_us", F.first("tail_start_us").over(in_episode))
        .withColumn("initiator_ip", F.first("tail_initiator").over(in_episode))
    )
    return after.select(
        *SLICE_KEYS,
        *[F.lag(name).over(along).alias(f"_carry_{name}") for name in CARRY_COLUMNS],
        F.lead("first_us").over(along).alias("_carry_next_us"),
        F.lead("first_forced").over(along).alias("_carry_next_forced"),
    ).filter(F.col("_carry_last_us").isNotNull() | F.col("_carry_next_us").isNotNull())


def scan_flows(
    rows: DataFrame, timeout_us: int, layout: Layout = Layout(), state: DataFrame | None = None
) -> DataFrame:
    """Add the flow state after each packet to rows that have flow_hash and flow_id.

    New columns: ``previous_us`` (previous packet of the flow), ``is_new`` (1 where
    a session starts), ``session`` (its number within the flow), ``session_start_us``,
    ``initiator_ip``, ``total_packets_in_flow``, ``total_bytes`` and ``is_last`` (true
    on a session's last packet).

    Rows with a column ``_forced`` also break where it is true.

    ``state`` holds one row per flow seen earlier, with ``CARRY_COLUMNS``. Without hot flows
    it is one more row of its flow, before all packets, so that nothing is scanned twice.
    """
    order, ts = layout.order, F.col("ts_us")
    keys, carried, seeded = FLOW_KEYS, False, False
    if state is not None and not layout.cuts_flows:
        seeded, order = True, ("_rank", *order)
        one = F.lit(1).cast("bigint")
        rows = rows.withColumns({"_rank": one, "_weight": one}).unionByName(state_as_rows(state), allowMissingColumns=True)
    elif layout.cuts_flows:
        keys, carried = SLICE_KEYS, True
        rows = layout.with_flow_slice(rows)
        needed = rows if state is not None else rows.filter(F.col("flow_slice") >= 0)
        summaries = summarize_slices(needed, order, timeout_us)
        if state is not None:
            summaries = summaries.unionByName(state_as_slices(state))
        rows = rows.join(carry_into_slices(summaries, timeout_us), list(SLICE_KEYS), "left")

    by_order = Window.partitionBy(*keys).orderBy(*order)
    run = _running(keys, order)
    previous = F.lag("ts_us").over(by_order)
    following = F.lead("ts_us").over(by_order)
    if carried:
        previous = F.coalesce(previous, F.col("_carry_last_us"))
        following = F.coalesce(following, F.col("_carry_next_us"))
    begins, ends = _gap(ts, F.col("previous_us"), timeout_us), _gap(F.col("_following"), ts, timeout_us)
    if "_forced" in rows.columns:
        next_forced = F.lead("_forced").over(by_order)
        next_forced = F.coalesce(next_forced, F.col("_carry_next_forced")) if carried else next_forced
        rows = rows.withColumn("_next_forced", next_forced)
        begins, ends = begins | F.col("_forced"), ends | F.col("_next_forced")
    scanned = (
        rows.withColumn("previous_us", previous)
        .withColumn("_following", following)
        .withColumn("_n", F.sum("_weight").over(run) if seeded else F.row_number().over(by_order).cast("bigint"))
        .withColumn("_bytes", F.sum("length").over(run))
        .withColumn("is_new", F.coalesce(begins, F.lit(True)).cast("bigint"))
        .withColumn("is_last", F.coalesce(ends, F.lit(True)))
    )
    opening = F.struct(
        (F.col("_n") - 1).alias("n"),
        (F.col("_bytes") - F.col("length")).alias("bytes"),
        F.col("ts_us").alias("start_us"),
        F.col("src_ip").alias("initiator_ip"),
    )
    opened, opens = F.col("is_new"), F.when(F.col("is_new") == 1, opening)
    if seeded:
        seed = F.col("_rank") == 0
        nothing = F.lit(0).cast("bigint")
        inherited = F.struct(nothing.alias("n"), nothing.alias("bytes"), F.col("_start_us").alias("start_us"), F.col("src_ip").alias("initiator_ip"))
        opened, opens = F.when(seed, F.col("_sessions")).otherwise(opened), F.when(seed, inherited).otherwise(opens)
    session = F.sum(opened).over(run)
    base = F.last(opens, ignorenulls=True).over(run)
    if carried:
        session = session + F.coalesce(F.col("_carry_sessions"), F.lit(0))
        inherited = F.struct(
            (-F.col("_carry_packets")).alias("n"),
            (-F.col("_carry_bytes")).alias("bytes"),
            F.col("_carry_start_us").alias("start_us"),
            F.col("_carry_initiator_ip").alias("initiator_ip"),
        )
        base = F.coalesce(base, inherited)
    out = (
        scanned.withColumn("session", session)
        .withColumn("_base", base)
        .withColumn("session_start_us", F.col("_base.start_us"))
        .withColumn("initiator_ip", F.col("_base.initiator_ip"))
        .withColumn("total_packets_in_flow", F.col("_n") - F.col("_base.n"))
        .withColumn("total_bytes", F.col("_bytes") - F.col("_base.bytes"))
    )
    if seeded:
        out = out.filter(F.col("_rank") == 1).drop("_rank", "_weight", "_start_us", "_sessions")
    helpers = ["_following", "_next_forced", "_n", "_bytes", "_base", "flow_slice"]
    helpers += [f"_carry_{c}" for c in (*CARRY_COLUMNS, "next_us", "next_forced")]
    return out.drop(*helpers)


def duration_us() -> Column:
    """Time from the session's first packet to this one; a clock that steps back counts as 0."""
    return F.greatest(F.col("ts_us") - F.col("session_start_us"), F.lit(0))


def duration_change_us() -> Column:
    """How much this packet adds to its session's duration."""
    earlier = F.greatest(F.col("previous_us") - F.col("session_start_us"), F.lit(0))
    return duration_us() - F.when(F.col("is_new") == 0, earlier).otherwise(0)


def with_flow_statistics(scanned: DataFrame) -> DataFrame:
    """Add duration, sizes, rates and gap of the flow as of each packet."""
    micros = float(MICROS)
    return (
        scanned.withColumn("duration_us", duration_us())
        .withColumn("flow_duration", F.col("duration_us") / F.lit(micros))
        .withColumns(
            {
                "avg_packet_size": F.expr("total_bytes / total_packets_in_flow"),
                # Without a duration there is no rate yet: the total itself stands in.
                "packet_rate": F.expr(
                    "CASE WHEN duration_us <= 0 THEN CAST(total_packets_in_flow AS DOUBLE)"
                    " ELSE total_packets_in_flow / flow_duration END"
                ),
                "byte_rate": F.expr(
                    "CASE WHEN duration_us <= 0 THEN CAST(total_bytes AS DOUBLE) ELSE total_bytes / flow_duration END"
                ),
                "inter_arrival_time": F.expr(
                    f"CASE WHEN is_new = 0 THEN greatest(ts_us - previous_us, 0) / CAST({MICROS} AS DOUBLE) END"
                ),
            }
        )
    )
