"""Per-packet features on a stream.

Each micro-batch is an ordinary table, so it runs through the same flow scan as
a batch table and a hot flow is cut into slices in the same way. What carries
over are the flows still open and the totals behind the average flow time. A
micro-batch reads the records of the flows it touches and of those that ran out,
and writes what changed, under its number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wiretide.functions.flowkey import FLOW_KEYS, with_flow_identity
from wiretide.functions.netaddr import with_direction
from wiretide.operators.flows import add_avg_flow_time, flow_records
from wiretide.operators.layout import TIME_ORDER, LayoutOptions, plan_layout
from wiretide.operators.packets import split_valid
from wiretide.operators.sessions import duration_change_us, scan_flows
from wiretide.plans.extract import feature_columns
from wiretide.schemas import ExtractionConfig
from wiretide.streaming.delivery import Handler, deliver
from wiretide.streaming.store import MOST_BUCKETS, FlowStore, Totals, bucket_of


@dataclass(frozen=True)
class Step:
    """What one micro-batch gives. All parts come from ``scan``, which is kept until it is unpersisted."""

    scan: DataFrame
    features: DataFrame
    closed_flows: DataFrame
    open_flows: DataFrame
    # The newest record of every flow that is in one of the two, and whether it is open.
    newest: DataFrame
    totals: DataFrame


@dataclass(frozen=True)
class Intake:
    """The usable packets of a micro-batch with their flows, kept, and what one pass over them tells."""

    rows: DataFrame
    packets: int
    flows: int
    latest_us: int | None
    buckets: frozenset[int]

    @staticmethod
    def of(packets: DataFrame) -> Intake:
        rows = with_flow_identity(split_valid(packets)[0]).persist()
        told = rows.agg(
            F.count(F.lit(1)), F.approx_count_distinct("flow_hash"), F.max("ts_us"), F.collect_set(bucket_of(MOST_BUCKETS))
        ).first()
        return Intake(rows, told[0], told[1], told[2], frozenset(told[3]))


def advance(
    packets: DataFrame,
    open_flows: DataFrame | None,
    totals: Totals,
    config: ExtractionConfig = ExtractionConfig(),
    options: LayoutOptions = LayoutOptions(),
    intake: Intake | None = None,
) -> Step:
    """Take the next packets: their features, the flows that are over, and what is carried on.

    ``open_flows`` needs the flows of these packets, and those that have run out and so are
    to be closed; others may be absent. Packets may come late; none is dropped. Like every
    clock that steps back, a late packet adds no negative time.
    """
    intake = intake or Intake.of(packets)
    rows = intake.rows
    layout = plan_layout(rows, TIME_ORDER, options, intake.packets)
    state = None
    if open_flows is not None:
        state = open_flows.select(
            *FLOW_KEYS,
            F.col("last_seen_us").alias("last_us"),
            F.col("total_packets").alias("packets"),
            F.col("total_bytes").alias("bytes"),
            "start_us",
            "initiator_ip",
            F.col("session").alias("sessions"),
        )
    scanned = with_direction(scan_flows(rows, config.timeout_us, layout, state), config.home_networks).persist()
    features = feature_columns(add_avg_flow_time(scanned, layout, totals.duration_us, totals.flows))

    # The last record of every session touched, and the sessions that were open before.
    records = flow_records(scanned.filter("is_last"))
    if open_flows is not None:
        # Ports keep the type that the packets give them.
        records = records.unionByName(open_flows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in records.schema.fields]))
    names = [c for c in records.columns if c not in (*FLOW_KEYS, "session")]
    sessions = (
        records.groupBy(*FLOW_KEYS, "session")
        .agg(F.max_by(F.struct(*names), "total_packets").alias("_r"))
        .select(*FLOW_KEYS, "session", "_r.*")
    )
    latest = max(totals.latest_us, totals.latest_us if intake.latest_us is None else intake.latest_us)
    sessions = sessions.withColumn("_newest", F.max("session").over(Window.partitionBy(*FLOW_KEYS)))
    last = F.col("session") == F.col("_newest")
    alive = last & (F.lit(latest) - F.col("last_seen_us") <= config.timeout_us)
    sessions = sessions.withColumns({"_last": last, "open": alive}).drop("_newest")

    sums = scanned.agg(
        (F.coalesce(F.sum(duration_change_us()), F.lit(0)) + totals.duration_us).alias("duration_us"),
        (F.coalesce(F.sum("is_new"), F.lit(0)) + totals.flows).alias("flows"),
        F.lit(latest).alias("latest_us"),
    )
    part = lambda rows: rows.drop("_last", "open")
    return Step(
        scanned, features, part(sessions.filter("NOT open")), part(sessions.filter("open")), sessions.filter("_last").drop("_last"), sums
    )


class Progress:
    """One micro-batch after the other through ``advance``, with the store between them."""

    def __init__(self, store: FlowStore, config: ExtractionConfig = ExtractionConfig(), options: LayoutOptions = LayoutOptions()):
        self.store, self.config, self.options = store, config, options

    def take(self, packets: DataFrame, batch_id: int, on_features: Handler | None = None, on_closed: Handler | None = None) -> None:
        """The handlers get the features and the flows that ended; then the store goes on to this number."""
        manifest = self.store.manifest_before(batch_id)
        intake = Intake.of(packets)
        totals, kept = manifest.totals, [intake.rows]
        try:
            latest = max(totals.latest_us, totals.latest_us if intake.latest_us is None else intake.latest_us)
            horizon = latest - self.config.timeout_us
            known = None
            if manifest.runs:
                flows = intake.rows.select(*FLOW_KEYS)
                known = self.store.lookup(manifest, flows, set(intake.buckets), horizon).persist()
                kept.append(known)
            step = advance(packets, known, totals, self.config, self.options, intake)
            kept.append(step.scan)
            if on_features is not None:
                on_features(step.features, batch_id)
            if on_closed is not None:
                on_closed(step.closed_flows, batch_id)
            after = Totals(**step.totals.first().asDict())
            self.store.commit(batch_id, manifest, step.newest, after, intake.flows, horizon)
        finally:
            for df in kept:
                df.unpersist()


def stream_features(
    packets: DataFrame,
    folder: str,
    on_features: Handler,
    on_closed: Handler | None = None,
    on_rejected: Handler | None = None,
    config: ExtractionConfig = ExtractionConfig(),
    options: LayoutOptions = LayoutOptions(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start extraction on a packet stream.

    ``on_features`` gets the features of each micro-batch, ``on_closed`` the flows
    that ended, ``on_rejected`` the unusable packets with the reason. A handler is
    called again with the same number if a micro-batch is repeated, so it should
    write under that number. Wrap it in ``isolated`` to go on after its errors. The
    trigger and the source's limit on files or offsets bound a micro-batch.
    """
    if config.cleanup_interval_seconds is not None or config.max_tracked_flows is not None:
        raise ValueError("sweeps and a cap on tracked flows are for tables; a stream ends idle flows at once")
    progress = Progress(FlowStore(packets.sparkSession, f"{folder}/state"), config, options)

    def take(batch: DataFrame, batch_id: int) -> None:
        progress.take(batch, batch_id, on_features, on_closed)
        if on_rejected is not None:
            on_rejected(split_valid(batch)[1], batch_id)

    return deliver(packets, take, folder, trigger)
