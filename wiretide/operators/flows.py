"""Reports on whole flows, and statistics over all flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.functions.flowkey import FLOW_KEYS, with_endpoints, with_flow_identity
from wiretide.functions.packets import connection_state
from wiretide.operators.layout import TIME_ORDER, Layout, LayoutOptions, plan_layout
from wiretide.operators.running import running_totals
from wiretide.operators.select import TASK_ROWS, largest_rows
from wiretide.operators.sessions import duration_change_us, scan_flows, with_flow_statistics
from wiretide.operators.tracking import scan
from wiretide.schemas import MICROS, ExtractionConfig

FLOW_COLUMNS = (
    "flow_id", "session", "endpoint_1_ip", "endpoint_1_port", "endpoint_2_ip", "endpoint_2_port", "protocol",
    "start_us", "last_seen_us", "total_packets", "total_bytes", "connection_state", "initiator_ip",
    "duration_us", "duration", "avg_packet_size", "packet_rate", "byte_rate",
)


def _scanned(packets: DataFrame, config: ExtractionConfig, order, options: LayoutOptions):
    rows = with_flow_identity(packets)
    layout = plan_layout(rows, order, options)
    return scan(rows, config, layout), layout


def flow_records(scanned: DataFrame) -> DataFrame:
    """The flow record that holds after each packet of a scan."""
    flags = F.col("tcp_flags") if "tcp_flags" in scanned.columns else F.lit(None).cast("string")
    return with_flow_statistics(with_endpoints(scanned)).select(
        *FLOW_KEYS,
        "session",
        "endpoint_1_ip",
        "endpoint_1_port",
        "endpoint_2_ip",
        "endpoint_2_port",
        "protocol",
        F.col("session_start_us").alias("start_us"),
        F.col("ts_us").alias("last_seen_us"),
        F.col("total_packets_in_flow").alias("total_packets"),
        "total_bytes",
        connection_state(flags, F.col("protocol")).alias("connection_state"),
        "initiator_ip",
        "duration_us",
        F.col("flow_duration").alias("duration"),
        "avg_packet_size",
        "packet_rate",
        "byte_rate",
    )


def flow_summary(
    packets: DataFrame,
    config: ExtractionConfig = ExtractionConfig(),
    order: tuple[str, ...] = TIME_ORDER,
    options: LayoutOptions = LayoutOptions(),
) -> DataFrame:
    """Final record of every flow session.

    The running record on a session's last packet is its final record, so the
    scan needs no aggregation after it.
    """
    scanned, _ = _scanned(packets, config, order, options)
    return flow_records(scanned.filter("is_last")).select(*FLOW_COLUMNS)


def _seen_until(packets: DataFrame, now_us: int) -> DataFrame:
    return packets.filter(F.col("ts_us") <= now_us)


def active_flows(
    packets: DataFrame, now_us: int, config: ExtractionConfig = ExtractionConfig(), options: LayoutOptions = LayoutOptions()
) -> DataFrame:
    """Flows that are tracked at ``now_us``: seen by then and not idle for longer than the timeout.

    Only the history of flows seen within the timeout is scanned; the others' packets
    leave before the flow shuffle.
    """
    live = F.lit(now_us) - F.col("last_seen_us") <= config.timeout_us
    recent = with_flow_identity(packets.filter(F.col("ts_us").between(now_us - config.timeout_us, now_us)))
    rows = with_flow_identity(_seen_until(packets, now_us)).join(recent.select("flow_hash").distinct(), "flow_hash", "left_semi")
    scanned = scan_flows(rows, config.timeout_us, plan_layout(rows, options=options))
    return flow_records(scanned.filter("is_last")).select(*FLOW_COLUMNS).filter(live)


def active_flow_count(packets: DataFrame, now_us: int, config: ExtractionConfig = ExtractionConfig()) -> DataFrame:
    """Number of flows tracked at ``now_us``.

    A flow is tracked exactly if it has a packet within the timeout before ``now_us``,
    so only that stretch of the table is read and no sessions are built.
    """
    recent = F.col("ts_us").between(now_us - config.timeout_us, now_us)
    flows = with_flow_identity(packets.filter(recent)).select(*FLOW_KEYS).distinct()
    return flows.agg(F.count(F.lit(1)).alias("active_flows"))


def expired_flows(
    packets: DataFrame, now_us: int, config: ExtractionConfig = ExtractionConfig(), options: LayoutOptions = LayoutOptions()
) -> DataFrame:
    """Flow sessions that were seen by ``now_us`` and idle for longer than the timeout."""
    over = F.lit(now_us) - F.col("last_seen_us") > config.timeout_us
    return flow_summary(_seen_until(packets, now_us), config, options=options).filter(over)


def mean_flow_time(flows: DataFrame) -> DataFrame:
    """Average duration in seconds over a flow summary, 0 if there is no flow."""
    n, total = F.count(F.lit(1)), F.sum("duration_us")
    mean = F.when(n > 0, total / F.lit(float(MICROS)) / n).otherwise(0.0)
    return flows.agg(n.alias("flows"), mean.alias("avg_flow_time"))


def most_recent_flows(flows: DataFrame, n: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The n flow sessions seen last, the latest first; n may be any share of them."""
    return largest_rows(flows, n, "last_seen_us", "flow_id", "session", task_rows=task_rows)


def add_avg_flow_time(
    scanned: DataFrame, layout: Layout = Layout(), start_duration_us: int = 0, start_flows: int = 0
) -> DataFrame:
    """Add the mean duration, as of each packet, of all sessions started so far, over all flows."""
    totals = running_totals(
        scanned,
        {"_duration_total": duration_change_us(), "_flow_total": F.col("is_new")},
        layout,
        {"_duration_total": start_duration_us, "_flow_total": start_flows},
    )
    mean = F.col("_duration_total") / F.lit(float(MICROS)) / F.col("_flow_total")
    return totals.withColumn("avg_flow_time", mean).drop("_duration_total", "_flow_total")


def active_flow_timeline(
    packets: DataFrame, config: ExtractionConfig = ExtractionConfig(), options: LayoutOptions = LayoutOptions()
) -> DataFrame:
    """Number of tracked flows after each packet.

    Every session counts one up when it starts and one down just after its idle
    time is over, which its last packet tells.
    """
    rows = with_flow_identity(packets.select("packet_id", "ts_us", "src_ip", "src_port", "dst_ip", "dst_port", "protocol", "length"))
    layout = plan_layout(rows, TIME_ORDER, options)
    scanned = scan_flows(rows, config.timeout_us, layout)
    one = F.lit(1).cast("bigint")
    before_packets = F.lit(-(2**63)).cast("bigint")
    start = F.struct("ts_us", "packet_id", F.col("is_new").alias("change"))
    end = F.struct(
        (F.col("ts_us") + config.timeout_us + 1).alias("ts_us"), before_packets.alias("packet_id"), (-one).alias("change")
    )
    events = scanned.select(F.explode(F.when(F.col("is_last"), F.array(start, end)).otherwise(F.array(start))).alias("e")).select("e.*")
    counted = running_totals(events, {"active_flows": F.col("change")}, layout)
    return counted.filter(F.col("packet_id") > before_packets).select("packet_id", "ts_us", "active_flows")
