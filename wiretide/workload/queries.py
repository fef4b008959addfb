"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wiretide.functions import packets as pf
from wiretide.functions import text, threat
from wiretide.functions.flowkey import with_endpoints, with_flow_identity
from wiretide.functions.netaddr import with_direction
from wiretide.operators import encode, evaluate, flows, networks
from wiretide.operators import packets as po
from wiretide.operators.layout import LayoutOptions, plan_layout
from wiretide.operators.sessions import scan_flows
from wiretide.operators.split import with_split
from wiretide.operators.tracking import scan
from wiretide.plans.extract import extract_features
from wiretide.plans.score import assess, score
from wiretide.plans.train import create_model, evaluate as evaluate_model, split_and_train
from wiretide.schemas import ATTACK_CATEGORIES, FEATURE_ORDER, MICROS, PACKET_SCHEMA, PREDICTION_SCHEMA, DetectionConfig, ExtractionConfig
from wiretide.sources import storage, tables
from wiretide.streaming.delivery import dead_letters, deliver, delivered, each_record, write_under_batch
from wiretide.streaming.flows import stream_features
from wiretide.streaming.late import in_time_stream, late_counts, late_packets, part_late
from wiretide.streaming.store import FlowStore
from wiretide.streaming.summary import end_mark, flow_summary_stream
from wiretide.workload import views

CONFIG = ExtractionConfig()
AS_OF_US = views.EPOCH_US + 1_800 * MICROS
CAPTURE_PACKETS = 500
LARGE_CAPTURE = 4_000
# A registered stream takes the table in so many micro-batches of so many files.
STREAM_BATCHES, STREAM_FILES = 4, 8
CAPTURE_SECONDS = 900.0
RECENT_FLOWS = 100
SWEEP_SECONDS, TRACKED_FLOWS = 5.0, 20
# Every so many-th packet comes at the end of the stream; seconds a packet may be late.
LATE_EVERY, LATE_DELAY = 50, 10.0
FIXED_NOW = float(views.EPOCH_US // MICROS)

# So fine that even small tables take the way of large ones: slices, hot flows, crowded instants.
CUT = LayoutOptions(rows_per_slice=700)
# The same with more slices than are cut at once.
NESTED = LayoutOptions(rows_per_slice=700, max_slices=6)


def _usable(spark: SparkSession, sf: str) -> DataFrame:
    return po.split_valid(views.packets(spark, sf))[0]


def packet_filter(spark, sf):
    return po.capture(views.packets(spark, sf)).drop("window_size")


def packet_limit(spark, sf):
    captured = po.capture(views.packets(spark, sf))
    return po.capture_limit(captured, CAPTURE_PACKETS, CAPTURE_SECONDS).select("packet_id", "ts_us")


def packet_time_limit(spark, sf):
    captured = po.capture(views.packets(spark, sf))
    return po.capture_limit(captured, timeout_seconds=CAPTURE_SECONDS).select("packet_id", "ts_us")


def dead_letter(spark, sf):
    rejected = po.split_valid(views.packets(spark, sf))[1]
    return rejected.groupBy("error").agg(F.count(F.lit(1)).alias("packets"))


def protocol_detect(spark, sf):
    number = F.when(F.col("protocol") == "TCP", 6).when(F.col("protocol") == "UDP", 17).when(F.col("protocol") == "ICMP", 1).otherwise(47)
    layers = F.when(F.col("packet_id") % 3 == 0, F.array(F.lit("IP"), F.lit("ICMP"), F.lit("UDP"))).otherwise(F.array(F.lit("IP"), F.col("protocol")))
    return views.packets(spark, sf).select(
        "packet_id",
        pf.protocol_from_number(number).alias("by_number"),
        pf.protocol_from_layers(layers).alias("by_layers"),
        pf.port_or_null(F.col("dst_port"), F.col("protocol")).alias("port"),
    )


def flow_key_id(spark, sf):
    out = with_flow_identity(with_endpoints(_usable(spark, sf)), keep_endpoints=True)
    return out.select("packet_id", "endpoint_1_ip", "endpoint_1_port", "endpoint_2_ip", "endpoint_2_port", "flow_id")


def packet_direction(spark, sf):
    return with_direction(_usable(spark, sf), CONFIG.home_networks).select("packet_id", "src_ip", "dst_ip", "direction")


def packet_direction_v6(spark, sf):
    home = (*CONFIG.home_networks, "fd00::/8")
    return with_direction(views.packets_v6(spark, sf), home).select("packet_id", "src_ip", "dst_ip", "direction")


def direction_by_table(spark, sf):
    """Home networks taken from the data: one /25 or so per client address of the packets."""
    packets = _usable(spark, sf)
    octet = F.split_part("src_ip", F.lit("."), F.lit(4)).cast("int")
    home = packets.filter(F.col("src_ip").startswith("192.168.1.")).select(
        F.concat(F.lit("192.168.1."), octet.cast("string"), F.lit("/32")).alias("cidr")
    )
    return networks.with_direction_by_table(packets, home.distinct()).select("packet_id", "direction")


def direction_by_table_join(spark, sf):
    """As many networks as there are packets, IPv6 ones among them and two with a netmask."""
    packets = _usable(spark, sf)
    number = F.col("packet_id")
    cidr = (
        F.when(number % 5 == 0, F.concat(F.lit("fd00:"), F.hex(number % 65536), F.lit("::/33")))
        .when(number % 5 == 1, "10.0.0.0/255.0.0.0")
        .when(number % 5 == 2, "192.168.1.0/255.255.255.240")
        .otherwise(F.concat(F.lit("93.184.216."), (number % 3).cast("string")))
    )
    return networks.with_direction_by_table(packets, packets.select(cidr.alias("cidr"))).select("packet_id", "direction")


def direction_by_table_unreadable(spark, sf):
    """A long list with one network that cannot be read: no direction is known."""
    packets = _usable(spark, sf)
    cidr = F.when(F.col("packet_id") == 1, "10.0.0.0/99").otherwise(F.concat(F.lit("10.0.0."), (F.col("packet_id") % 256).cast("string")))
    return networks.with_direction_by_table(packets, packets.select(cidr.alias("cidr"))).select("packet_id", "direction")


def tcp_state(spark, sf):
    state = pf.connection_state(F.col("tcp_flags"), F.col("protocol"))
    return views.packets(spark, sf).select("packet_id", "tcp_flags", state.alias("connection_state"))


def payload_size(spark, sf):
    return po.with_metadata(_usable(spark, sf)).select("packet_id", "payload_size")


def extra_fields(spark, sf):
    """The optional fields read from an open map that holds only some of them."""
    size, key = F.col("payload_size").cast("string"), F.lit("payload_size")
    extra = F.when(F.col("packet_id") % 3 == 0, F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(key, size, F.lit("ttl"), F.col("ttl").cast("string"))
    )
    typed = ("ttl", "tcp_flags", "payload_size")
    packets = _usable(spark, sf).withColumn("extra", extra).drop(*typed)
    return po.with_metadata(packets).select("packet_id", *typed)


def flow_sessions(spark, sf):
    rows = with_flow_identity(_usable(spark, sf))
    scanned = scan_flows(rows, CONFIG.timeout_us, plan_layout(rows))
    return scanned.select("packet_id", "flow_id", "session", "session_start_us", "initiator_ip", "is_new")


def _sessions_under(spark, sf, **settings) -> DataFrame:
    rows = with_flow_identity(_usable(spark, sf))
    scanned = scan(rows, ExtractionConfig(**settings), plan_layout(rows, options=CUT))
    return scanned.select("packet_id", "flow_id", "session", "session_start_us", "initiator_ip", "is_new", "is_last")


def flow_sessions_swept(spark, sf):
    """Flow sessions where idle flows end only at sweeps, five seconds apart at least."""
    return _sessions_under(spark, sf, cleanup_interval_seconds=SWEEP_SECONDS)


def flow_sessions_capped(spark, sf):
    """Flow sessions where a new flow displaces the one seen longest ago once so many are tracked."""
    return _sessions_under(spark, sf, max_tracked_flows=TRACKED_FLOWS)


def packet_features(spark, sf):
    return extract_features(views.packets(spark, sf), avg_flow_time=False).drop("extra", "window_size")


def full_features(spark, sf):
    return extract_features(views.packets(spark, sf)).drop("extra", "window_size")


def avg_flow_time(spark, sf):
    rows = with_flow_identity(_usable(spark, sf))
    layout = plan_layout(rows)
    scanned = scan_flows(rows, CONFIG.timeout_us, layout)
    return flows.add_avg_flow_time(scanned, layout).select("packet_id", "avg_flow_time")


def active_flow_timeline(spark, sf):
    return flows.active_flow_timeline(_usable(spark, sf))


def flow_summary(spark, sf):
    return flows.flow_summary(_usable(spark, sf))


def _packets_hot(spark: SparkSession, sf: str) -> DataFrame:
    # A table, as packets are: the view's nested cases would be spelled out wherever a column is used.
    return storage.materialize(views.packets_hot(spark, sf), "packets-hot")


def _usable_hot(spark: SparkSession, sf: str) -> DataFrame:
    return po.split_valid(_packets_hot(spark, sf))[0]


def packet_limit_large(spark, sf):
    """A limit that keeps several slices whole and ends within one."""
    captured = po.capture(_packets_hot(spark, sf))
    return po.capture_limit(captured, LARGE_CAPTURE, options=CUT).select("packet_id", "ts_us")


def full_features_cut(spark, sf):
    return extract_features(_packets_hot(spark, sf), options=CUT).drop("extra", "window_size")


def full_features_nested(spark, sf):
    return extract_features(_packets_hot(spark, sf), options=NESTED).drop("extra", "window_size")


def active_flow_timeline_nested(spark, sf):
    return flows.active_flow_timeline(_usable_hot(spark, sf), options=NESTED)


def active_flow_timeline_cut(spark, sf):
    return flows.active_flow_timeline(_usable_hot(spark, sf), options=CUT)


def flow_summary_cut(spark, sf):
    return flows.flow_summary(_usable_hot(spark, sf), options=CUT)


def active_flows_asof(spark, sf):
    return flows.active_flows(_usable(spark, sf), AS_OF_US).select("flow_id", "start_us", "last_seen_us", "total_packets")


def active_flow_count(spark, sf):
    return flows.active_flow_count(_usable(spark, sf), AS_OF_US)


def expired_flows_asof(spark, sf):
    return flows.expired_flows(_usable(spark, sf), AS_OF_US).select("flow_id", "session", "last_seen_us", "duration_us")


def mean_flow_time(spark, sf):
    return flows.mean_flow_time(flows.flow_summary(_usable(spark, sf)))


def recent_flows_topk(spark, sf):
    return flows.most_recent_flows(flows.flow_summary(_usable(spark, sf)), RECENT_FLOWS).select(
        "flow_id", "session", "last_seen_us", "total_packets"
    )


def recent_flows_half(spark, sf):
    """The half of the flow sessions that was seen last, found without an ordered list of them."""
    summary = storage.materialize(flows.flow_summary(_usable(spark, sf)), "summary")
    chosen = flows.most_recent_flows(summary, summary.count() // 2, task_rows=10)
    return chosen.select("flow_id", "session", "last_seen_us", "total_packets")


def normalize_label(spark, sf):
    return views.scored(spark, sf).select("id", threat.normalize_category(F.col("raw_label")).alias("category"))


def severity(spark, sf):
    return views.scored(spark, sf).select("id", threat.severity(F.col("confidence")).alias("severity"))


def threat_label(spark, sf):
    category = threat.normalize_category(F.col("raw_label"))
    return views.scored(spark, sf).select("id", threat.threat_label(category, F.col("confidence")).alias("threat_label"))


def risk_score(spark, sf):
    category = threat.normalize_category(F.col("raw_label"))
    return views.scored(spark, sf).select("id", threat.risk_score(category, F.col("confidence")).alias("risk_score"))


def severity_by_table(spark, sf):
    """Severity bands taken from a table: one per region, twenty points each."""
    bands = spark.read.parquet(f"{sf}/region.parquet").select(F.col("r_name").alias("name"), (F.col("r_regionkey") * 20 + 19.5).alias("upper"))
    return threat.with_severity_from_table(views.scored(spark, sf), bands).select("id", "severity")


def risk_by_table(spark, sf):
    """Category weights taken from a table: the share of each class among the labelled rows."""
    pairs = views.eval_pairs(spark, sf)
    weights = pairs.groupBy(F.col("y_true").alias("category")).agg((F.count(F.lit(1)) / F.lit(pairs.count())).alias("weight"))
    rows = views.scored(spark, sf).withColumn("category", threat.normalize_category(F.col("raw_label")))
    return threat.with_risk_from_table(rows, weights, 0.5).select("id", "category", "risk_score")


def feature_select(spark, sf):
    return encode.select_inputs(extract_features(views.packets(spark, sf), avg_flow_time=True), "packet_id")


def feature_encode(spark, sf):
    features = extract_features(views.packets(spark, sf), avg_flow_time=True)
    return encode.encode(encode.select_inputs(features, "packet_id"), "packet_id")


def feature_vector(spark, sf):
    """The vector that a model is given, place by place under the names of the inputs."""
    features = extract_features(views.packets(spark, sf), avg_flow_time=True)
    vectors = PipelineModel(encode.encoding_stages()).transform(features).select("packet_id", vector_to_array("_vector").alias("v"))
    return vectors.select("packet_id", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(FEATURE_ORDER)], F.size("v").alias("places"))


def packets_table(spark, sf):
    """Packets written as a table and read by the library's own reader and schema."""
    path = storage.work_folder(spark, "packets-table")
    packets = views.packets(spark, sf)
    known = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PACKET_SCHEMA.fields if f.name in packets.columns]
    packets.select(*known).write.parquet(path)
    return tables.read_packets(spark, path).drop("window_size")


def partial_dataset(spark, sf):
    """Training rows from a table of text that lacks most columns."""
    table = views.labelled_packets(spark, sf).select(
        F.col("packet_id").alias("row_id"),
        F.when(F.col("packet_id") % 4 == 0, "n/a").otherwise(F.col("length").cast("string")).alias("packet_length"),
        F.col("ttl").cast("string").alias("ttl"),
        F.lower("protocol").alias("protocol"),
        F.lower("label").alias("label"),
    )
    rows = encode.labelled_inputs(table, "label", "row_id")
    return encode.encode(rows, "row_id", "label").select("row_id", "packet_length", "ttl", "byte_rate", "protocol", "direction", "label")


def scorable_split(spark, sf):
    """Feature rows that a model cannot take, by reason."""
    bad = F.when(F.col("packet_id") % 101 == 0, float("nan")).when(F.col("packet_id") % 103 == 0, float("inf"))
    features = extract_features(views.packets(spark, sf), avg_flow_time=True)
    broken = features.withColumn("byte_rate", F.coalesce(bad, F.col("byte_rate")))
    kept, rejected = encode.split_scorable(broken)
    counted = tables.union_rows(kept, rejected).groupBy("error")
    return counted.agg(F.count(F.lit(1)).alias("rows"))


def class_weights(spark, sf):
    return evaluate.class_weights(views.eval_pairs(spark, sf), "y_true")


def label_classes(spark, sf):
    return evaluate.label_classes(views.eval_pairs(spark, sf), "y_true")


def dataset_profile(spark, sf):
    return evaluate.dataset_profile(encode.complete_inputs(views.packets(spark, sf)))


def stratified_split(spark, sf):
    return with_split(views.eval_pairs(spark, sf), "y_true", "id").select("id", "y_true", "split")


def stratified_split_many(spark, sf):
    """A split by so many classes that their cuts are a joined table."""
    rows = views.eval_pairs(spark, sf).select("id", F.concat(F.lit("c"), (F.col("id") % 2003).cast("string")).alias("class"))
    return with_split(rows, "class", "id", 0.3).select("id", "class", "split")


def confusion(spark, sf):
    return evaluate.confusion(views.eval_pairs(spark, sf))


def eval_metrics(spark, sf):
    return evaluate.metrics(views.eval_pairs(spark, sf))


def classification_report(spark, sf):
    return evaluate.classification_report(views.eval_pairs(spark, sf))


def union_rows(spark, sf):
    packets = views.packets(spark, sf)
    left = packets.filter(F.col("protocol") == "TCP").select("packet_id", "tcp_flags")
    right = packets.filter(F.col("protocol") != "TCP").select("packet_id", "protocol", "length")
    return tables.union_rows(left, right)


def packet_text(spark, sf):
    return views.packets(spark, sf).select("packet_id", text.packet_summary().alias("summary"))


def feature_text(spark, sf):
    features = extract_features(views.packets(spark, sf), avg_flow_time=False)
    return features.select("packet_id", text.feature_summary().alias("summary"))


def packet_json(spark, sf):
    record = views.packets(spark, sf).select("packet_id", "src_ip", "src_port", "protocol", "length")
    return text.as_json(record)


def _read_back(records: DataFrame) -> DataFrame:
    """The fields of records, from their JSON form, and the names it has."""
    value = text.as_json(records).withColumn("fields", F.array_join(F.array_sort(F.json_object_keys("value")), ","))
    return value.select(F.from_json("value", records.schema).alias("r"), "fields").select("r.*", "fields")


def packet_record_json(spark, sf):
    """Whole packet records as JSON, and what a reader finds in it."""
    return _read_back(views.packets(spark, sf))


def feature_json(spark, sf):
    """Whole feature records as JSON, and what a reader finds in it."""
    return _read_back(extract_features(views.packets(spark, sf))).drop("extra", "window_size")


def _prediction_records(spark, sf) -> DataFrame:
    """Prediction records from given class probabilities, under the id of their row."""
    classes = ["BENIGN", "DDOS", "PHISHING", "PORT_SCAN"]
    columns = assess(F.array("p_benign", "p_ddos", "p_phishing", "p_scan"), classes, "given", DetectionConfig(), F.lit(FIXED_NOW))
    out = views.probabilities(spark, sf).withColumn("flow_id", F.lit(None).cast("string"))
    for name, column in columns.items():
        out = out.withColumn(name, column)
    return out.select("id", *PREDICTION_SCHEMA.fieldNames())


def prediction_json(spark, sf):
    """Whole prediction records as JSON, and what a reader finds in it."""
    read = _read_back(_prediction_records(spark, sf))
    chances = [F.element_at("class_probabilities", c).alias(f"p_{c.lower()}") for c in ("BENIGN", "DDOS", "PHISHING", "PORT_SCAN")]
    return read.select("*", *chances).drop("class_probabilities")


def predictions(spark, sf):
    """Predictions from given class probabilities."""
    out = _prediction_records(spark, sf).withColumn("summary", text.prediction_summary())
    return out.select(
        "id", "attack_category", "confidence_score", "threat_label", "severity", "risk_score", "prediction_timestamp",
        F.element_at("class_probabilities", "DDOS").alias("ddos_probability"), "summary",
    )


def feature_csv(spark, sf):
    """Features written as CSV with sorted columns and read back."""
    path = storage.work_folder(spark, "feature-csv")
    tables.write_features_csv(extract_features(views.packets(spark, sf), avg_flow_time=False), path)
    schema = "packet_id long, flow_id string, direction string, total_bytes long, byte_rate double, extra string"
    read = spark.read.option("header", True).csv(path)
    names = [f.split()[0] for f in schema.split(", ")]
    return read.select(*[F.col(n).cast(f.split()[1]).alias(n) for n, f in zip(names, schema.split(", "))])


def _labelled_csv(spark, sf, parts=None) -> str:
    """A labelled data set with odd headers, as CSV."""
    path = storage.work_folder(spark, "labelled-csv")
    table = views.labelled_packets(spark, sf).select(
        F.col("packet_id").cast("double").alias(" Flow Duration"),
        F.col("length").alias("Pkt Len"),
        F.lower("protocol").alias(" protocol "),
        F.translate(F.lower("label"), "_", "-").alias(" Label"),
    )
    table = table.repartition(parts) if parts else table
    table.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


CSV_NAMES = {" Flow Duration": "flow_duration", "Pkt Len": "packet_length"}


def labelled_csv(spark, sf):
    """A labelled data set with odd headers, written as CSV and loaded."""
    rows = tables.read_labelled_csv(spark, _labelled_csv(spark, sf), "Label ", CSV_NAMES)
    return encode.encode(rows, "label").select("flow_duration", "packet_length", "protocol", "total_bytes", "label")


def labelled_csv_split(spark, sf):
    """The same data set stored in one file and in many: rows that fall on different sides of the split, none."""
    sides = [with_split(tables.read_labelled_csv(spark, _labelled_csv(spark, sf, n), "Label ", CSV_NAMES), "label", "row_id") for n in (1, 13)]
    left, right = (s.select("row_id", F.col("split").alias(name)) for s, name in zip(sides, "ab"))
    joined = left.join(right, "row_id", "full")
    differ = F.count_if(~F.col("a").eqNullSafe(F.col("b")))
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") == "test").alias("test_rows"), differ.alias("differences"))


def _broken_csv(spark, sf) -> str:
    """The labelled data set as lines, of which some have a cell too many and some lack one."""
    path = storage.work_folder(spark, "broken-csv")
    number, cells = F.col("packet_id"), F.concat_ws(",", F.col("packet_id").cast("string"), F.col("length").cast("string"), F.lower("label"))
    line = F.when(number % 19 == 0, F.concat(cells, F.lit(",5"))).when(number % 23 == 0, F.substring_index(cells, ",", 2)).otherwise(cells)
    quoted = F.when(number % 29 == 0, F.concat_ws(",", F.col("packet_id").cast("string"), F.lit('"1,5"'), F.lower("label"))).otherwise(line)
    # One column of whole lines, whose name is the header of every file.
    lines = views.labelled_packets(spark, sf).repartition(4, "packet_id").select(quoted.alias("packet_length,ttl,label"))
    lines.write.csv(path, header=True, sep="\t", quote="")
    return path


def labelled_csv_rejects(spark, sf):
    """Lines of a data set that have more or fewer cells than its header, with the reason."""
    return tables.rejected_csv_rows(spark, _broken_csv(spark, sf)).select("record", "error")


def _train(spark, sf, **forest):
    # Training reads its table several times; the flow scan behind it should run once.
    table = storage.materialize(extract_features(views.labelled_packets(spark, sf), keep=("label",)), "training")
    model = create_model("random_forest", **forest)
    train, test = split_and_train(model, table, "packet_id")
    return model, train, test


_FORESTS: dict[tuple[str, str], tuple] = {}


def _trained(spark, sf):
    """The library's default forest on a table, trained once per application and shared by the queries below."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FORESTS:
        _FORESTS[key] = _train(spark, sf)
    return _FORESTS[key]


def train_and_score(spark, sf, **forest):
    """Predictions for the test rows, by the default forest or one with other settings."""
    model, _, test = _train(spark, sf, **forest) if forest else _trained(spark, sf)
    return score(test, model, now=F.lit(FIXED_NOW), keep=("packet_id",))


def train_and_evaluate(spark, sf):
    model, _, test = _trained(spark, sf)
    return evaluate_model(model, test)[1]


def evaluation_checks(spark, sf):
    """What must hold of the report on a trained model: its rows, their supports, and how its numbers hang together."""
    report = train_and_evaluate(spark, sf)
    sums = F.col("precision") + F.col("recall")
    f1 = F.when(sums > 0, 2 * F.col("precision") * F.col("recall") / F.nullif(sums, F.lit(0.0))).otherwise(0.0)
    of_class = F.col("label").isin(*ATTACK_CATEGORIES)
    bounded = [F.col(c).between(0.0, 1.0) for c in ("precision", "recall", "f1")]
    return report.select(
        "label",
        F.col("support").cast("bigint").alias("support"),
        (bounded[0] & bounded[1] & bounded[2]).alias("in_bounds"),
        F.when(of_class, F.abs(F.col("f1") - f1) < 1e-9).otherwise(True).alias("f1_follows"),
    )


def saved_model(spark, sf):
    """Test rows, and those of them on which a model and its saved and reloaded copy differ: none."""
    model, _, test = _trained(spark, sf)
    path = storage.work_folder(spark, "model")
    model.save(path)
    copy = create_model("random_forest").load(spark, path)
    left = model.predict(test).select("packet_id", "predicted")
    right = copy.predict(test).select("packet_id", F.col("predicted").alias("again"))
    both = left.join(right, "packet_id")
    differ = F.count_if(F.col("predicted") != F.col("again"))
    return both.agg(differ.alias("differences"), F.count(F.lit(1)).alias("rows"))


def prediction_checks(spark, sf):
    """What must hold of a trained model's predictions, for every test packet and its flow."""
    values = F.map_values("class_probabilities")
    best = F.array_max(values)
    severity = F.expr(
        "CASE WHEN confidence_score <= 30 THEN 'LOW' WHEN confidence_score <= 70 THEN 'MEDIUM'"
        " WHEN confidence_score <= 90 THEN 'HIGH' ELSE 'CRITICAL' END"
    )
    label = F.expr(
        "CASE WHEN attack_category = 'BENIGN' THEN 'BENIGN' WHEN confidence_score < 50 THEN 'SUSPICIOUS' ELSE 'MALICIOUS' END"
    )
    return train_and_score(spark, sf).select(
        "packet_id",
        "flow_id",
        (F.abs(F.aggregate(values, F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9).alias("sum_to_one"),
        (F.try_element_at("class_probabilities", F.col("attack_category")) == best).alias("likeliest"),
        (F.col("confidence_score") == best * 100.0).alias("confidence_follows"),
        (F.col("severity") == severity).alias("severity_follows"),
        (F.col("threat_label") == label).alias("label_follows"),
        F.col("risk_score").between(0.0, F.col("confidence_score")).alias("risk_in_bounds"),
    )


def _packet_stream(spark, sf) -> DataFrame:
    """The packets as a stream of STREAM_BATCHES micro-batches, in order of time."""
    path, packets = storage.work_folder(spark, "packets"), views.packets(spark, sf)
    edges = packets.approxQuantile("ts_us", [i / STREAM_BATCHES for i in range(1, STREAM_BATCHES)], 0.01)
    number = sum((F.col("ts_us") >= edge).cast("int") for edge in edges)
    for i in range(STREAM_BATCHES):
        packets.filter(number == i).repartition(STREAM_FILES).write.mode("append").parquet(path)
    return tables.stream_packets(spark, path, schema=packets.schema, maxFilesPerTrigger=STREAM_FILES)


def _source_number(packet: dict) -> dict:
    """A user's callback: fails on addresses that are none."""
    return {"packet_id": packet["packet_id"], "source": int(ipaddress.IPv4Address(packet["src_ip"]))}


def delivery_stream(spark, sf):
    """Every packet of a stream handed to a callback; what came back, and why others failed."""
    folder = storage.work_folder(spark, "delivery-stream")
    schema = "packet_id long, source long"
    handler = each_record(_source_number, f"{folder}/out", schema)
    deliver(_packet_stream(spark, sf), handler, folder, {"availableNow": True}).awaitTermination()
    taken = delivered(spark, f"{folder}/out", schema).drop("batch")
    failed = dead_letters(spark, f"{folder}/out")
    error = F.split_part("error", F.lit(":"), F.lit(1)).alias("error")
    failed = failed.select(F.get_json_object("record", "$.packet_id").cast("bigint").alias("packet_id"), error)
    return tables.union_rows(taken, failed)


def features_stream(spark, sf):
    """Per-packet features from a stream that takes the whole table; the same rows as in batch."""
    folder = storage.work_folder(spark, "features-stream")
    features = write_under_batch(f"{folder}/features")
    stream_features(_packet_stream(spark, sf), folder, features, trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{folder}/features").drop("batch", "extra", "window_size")


def closed_flows_stream(spark, sf):
    """Flow sessions a stream closes one micro-batch after the other, and those still open at its end."""
    folder = storage.work_folder(spark, "closed-flows-stream")
    query = stream_features(
        _packet_stream(spark, sf),
        folder,
        lambda features, batch_id: None,
        on_closed=write_under_batch(f"{folder}/closed"),
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    columns = [c for c in flows.FLOW_COLUMNS if c != "session"]
    still_open, _ = FlowStore(spark, f"{folder}/state").before(2**62)
    return spark.read.parquet(f"{folder}/closed").select(*columns).unionByName(still_open.select(*columns))


def summary_stream(spark, sf):
    """Flow sessions by session windows on a stream over the whole table, to its end."""
    folder = storage.work_folder(spark, "summary-stream")
    packets = views.packets(spark, sf)
    packets.unionByName(end_mark(packets), allowMissingColumns=True).write.option("maxRecordsPerFile", storage.FILE_ROWS).parquet(f"{folder}/packets")
    stream = tables.stream_packets(spark, f"{folder}/packets", schema=packets.schema)
    query = (
        flow_summary_stream(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/flows")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/flows")


def late_packets_stream(spark, sf):
    """A stream that ends with late packets: what is set aside, and what the flow sessions of the rest hold."""
    folder, packets = storage.work_folder(spark, "late-packets-stream"), views.packets(spark, sf)
    delayed = F.col("packet_id") % LATE_EVERY == 0
    edge = packets.approxQuantile("ts_us", [0.5], 0.01)[0]
    ending = packets.limit(0).unionByName(end_mark(packets, LATE_DELAY), allowMissingColumns=True)
    for part in (packets.filter(~delayed & (F.col("ts_us") < edge)), packets.filter(~delayed & (F.col("ts_us") >= edge)), packets.filter(delayed), ending):
        part.write.mode("append").option("maxRecordsPerFile", storage.FILE_ROWS).parquet(f"{folder}/packets")
        # Each part is one micro-batch, of as many files as it takes.
        source = tables.stream_packets(spark, f"{folder}/packets", schema=packets.schema)
        part_late(source, folder, LATE_DELAY, trigger={"availableNow": True}).awaitTermination()
    in_time = in_time_stream(spark, folder, packets.schema)
    query = (
        flow_summary_stream(in_time, f"{LATE_DELAY} seconds")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/flows")
    )
    query.awaitTermination()
    late = late_packets(spark, folder, packets.schema).select("packet_id", F.lit("late").alias("fate"), F.lit(1).cast("bigint").alias("packets"))
    counted = late_counts(spark, folder).agg(F.sum("late").alias("packets")).select(F.lit(None).cast("bigint").alias("packet_id"), F.lit("late, counted").alias("fate"), "packets")
    kept = spark.read.parquet(f"{folder}/flows").agg(F.sum("total_packets").alias("packets"))
    kept = kept.select(F.lit(None).cast("bigint").alias("packet_id"), F.lit("in flow sessions").alias("fate"), "packets")
    return late.unionAll(counted).unionAll(kept)


def score_stream(spark, sf):
    """Predictions on a stream of feature rows, by a model trained on the same table."""
    return _scored_stream(spark, sf, *_trained(spark, sf))


def score_stream_checks(spark, sf):
    """Every packet is scored once on the stream, with what the same model says in batch."""
    model, train, test = _trained(spark, sf)
    names = ("attack_category", "confidence_score", "threat_label", "severity", "risk_score")
    on_stream = _scored_stream(spark, sf, model, train, test).groupBy("packet_id", "flow_id")
    on_stream = on_stream.agg(F.count(F.lit(1)).alias("times"), *[F.min(c).alias(f"_{c}") for c in names])
    in_batch = score(tables.union_rows(train, test), model, now=F.lit(FIXED_NOW), keep=("packet_id",))
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"_{c}") for c in names])
    joined = in_batch.select("packet_id", "flow_id", *names).join(on_stream, ["packet_id", "flow_id"], "full")
    return joined.select("packet_id", "flow_id", F.coalesce("times", F.lit(0)).alias("times"), F.coalesce(same, F.lit(False)).alias("as_in_batch"))


def _scored_stream(spark, sf, model, train, test):
    folder = storage.work_folder(spark, "score-stream")
    tables.union_rows(train, test).write.parquet(f"{folder}/features")
    schema = spark.read.parquet(f"{folder}/features").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/features")
    query = (
        score(stream, model, now=F.lit(FIXED_NOW), keep=("packet_id",))
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/predictions")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/predictions")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        packet_filter, packet_limit, packet_time_limit, dead_letter, protocol_detect, flow_key_id, packet_direction,
        packet_direction_v6, direction_by_table, tcp_state, payload_size, extra_fields, flow_sessions, packet_features,
        full_features, avg_flow_time, active_flow_timeline, flow_summary, full_features_cut, active_flow_timeline_cut,
        full_features_nested, active_flow_timeline_nested,
        flow_summary_cut, direction_by_table_join, direction_by_table_unreadable, active_flows_asof, active_flow_count,
        expired_flows_asof, mean_flow_time, recent_flows_topk, normalize_label, severity, threat_label, risk_score,
        feature_select, feature_encode, partial_dataset, scorable_split, class_weights, label_classes, dataset_profile,
        stratified_split, confusion, eval_metrics, classification_report, union_rows, packet_text, feature_text,
        packet_json, predictions, feature_csv, labelled_csv, train_and_score, train_and_evaluate, saved_model,
        flow_sessions_swept, flow_sessions_capped, late_packets_stream, recent_flows_half, severity_by_table, risk_by_table, feature_vector, packets_table, stratified_split_many,
        packet_record_json, feature_json, prediction_json, labelled_csv_split, labelled_csv_rejects, delivery_stream, evaluation_checks, score_stream_checks, prediction_checks, packet_limit_large, features_stream, closed_flows_stream, summary_stream, score_stream,
    )
}
