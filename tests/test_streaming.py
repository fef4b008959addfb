import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_sessions import CUT, T0, busy_table

from wiretide.operators import flows
from wiretide.operators.layout import LayoutOptions
from wiretide.operators.packets import capture
from wiretide.plans.extract import extract_features
from wiretide.plans.score import score
from wiretide.plans.train import create_model
from wiretide.sources import storage, tables
from wiretide.streaming.delivery import dead_letters, deliver, delivered, each_record, isolated, write_under_batch
from wiretide.streaming.flows import Progress, Totals, advance, stream_features
from wiretide.streaming.late import late_counts, late_packets, part_late
from wiretide.streaming.store import FlowStore
from wiretide.streaming.summary import end_mark, flow_summary_stream
from wiretide.workload import queries


def rows(df):
    columns = sorted(c for c in df.columns if c not in ("extra", "batch"))
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def batches(table, n):
    """The table in time order, cut into files of about equal size."""
    order = F.percent_rank().over(Window.orderBy("ts_us", "packet_id"))
    ranked = table.withColumn("_b", F.least(F.floor(order * n), F.lit(n - 1)).cast("int")).cache()
    return [ranked.filter(F.col("_b") == i).drop("_b") for i in range(n)]


@pytest.fixture(scope="module")
def table(spark):
    return busy_table(spark, 1200).cache()


def closed_sessions(flows_df):
    return sorted((r.flow_id, r.start_us, r.last_seen_us, r.total_packets, r.total_bytes, r.connection_state, r.initiator_ip) for r in flows_df.collect())


@pytest.mark.parametrize("options", [LayoutOptions(), CUT], ids=["whole", "cut"])
def test_stream_gives_the_batch_rows(spark, table, tmp_path, options):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    schema = table.schema
    start = lambda: stream_features(
        tables.stream_packets(spark, source, schema=schema, maxFilesPerTrigger=1),
        folder,
        write_under_batch(f"{folder}/features"),
        write_under_batch(f"{folder}/closed"),
        options=options,
        trigger={"availableNow": True},
    )
    parts = batches(table, 3)
    for part in parts[:2]:
        part.coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()
    # The stream is started anew and goes on from what it left behind.
    parts[2].coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()

    got = spark.read.parquet(f"{folder}/features")
    assert got.select("batch").distinct().count() == 3
    assert rows(got) == rows(extract_features(table))

    summary = flows.flow_summary(table).cache()
    end = table.agg(F.max("ts_us")).first()[0]
    open_flows, totals = FlowStore(spark, f"{folder}/state").before(99)
    still_open = flows.active_flows(table, end)
    assert closed_sessions(open_flows) == closed_sessions(still_open)
    over = summary.filter(F.lit(end) - F.col("last_seen_us") > 60_000_000)
    assert closed_sessions(spark.read.parquet(f"{folder}/closed")) == closed_sessions(over)
    assert totals.latest_us == end and totals.flows == summary.count()


def test_late_packets_are_kept_and_add_no_negative_time(spark, table):
    first, late = batches(table, 2)[::-1]
    one = advance(first, None, Totals())
    open_flows = one.open_flows.cache()
    totals = Totals(**one.totals.first().asDict())
    two = advance(late, open_flows, totals)
    got = two.features.cache()
    assert got.count() == late.count()
    assert got.filter("flow_duration < 0 OR inter_arrival_time < 0 OR avg_flow_time < 0").count() == 0


def test_a_repeated_batch_gives_the_same_result(spark, table, tmp_path):
    store, kept = FlowStore(spark, str(tmp_path / "state")), {}
    progress = Progress(store)
    parts = batches(table, 2)
    keep = lambda df, i: kept.update({i: rows(df)})
    for i, part in enumerate(parts):
        progress.take(part, i, keep)
    features, (left_open, totals) = kept[1], store.before(2)
    left_open = rows(left_open)
    # A new process that knows nothing but the folder does it again.
    Progress(FlowStore(spark, store.folder)).take(parts[1], 1, keep)
    assert kept[1] == features
    assert store.before(2)[1] == totals and rows(store.before(2)[0]) == left_open


def test_handler_errors_do_not_stop_a_stream(spark, table, tmp_path):
    seen = []

    def fail_once(df, batch_id):
        seen.append((batch_id, df.count()))
        if batch_id == 0:
            raise RuntimeError("broken")

    source = str(tmp_path / "in")
    for part in batches(table, 2):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = tables.stream_packets(spark, source, schema=table.schema, maxFilesPerTrigger=1)
    deliver(capture(stream), isolated(fail_once), str(tmp_path / "work"), {"availableNow": True}).awaitTermination()
    assert [b for b, _ in seen] == [0, 1] and sum(n for _, n in seen) == table.count()


def test_a_record_that_fails_is_a_dead_letter_and_the_others_are_delivered(spark, tmp_path):
    path, schema = str(tmp_path / "out"), "id long, half double"

    def half(record):
        if record["id"] == 3:
            raise KeyError("three")
        if record["id"] == 17:
            return {"id": "no number", "half": 1.0}
        return {"id": record["id"], "half": record["id"] / record["d"]}

    source = spark.range(20).selectExpr("id", "if(id = 5, 0, 2) AS d", "map('a', null) AS m", "struct(id AS x) AS s")
    handler = each_record(half, path, schema)
    handler(source.filter("id < 10"), 0)
    handler(source.filter("id >= 10"), 1)
    handler(source.filter("id >= 10"), 1)
    handler(source.limit(0), 2)
    got = {r.id: (r.half, r.batch) for r in delivered(spark, path, schema).collect()}
    assert got == {i: (i / 2, i // 10) for i in range(20) if i not in (3, 5, 17)}
    failed = {(json.loads(r.record)["id"], r.error.split(":")[0], r.batch) for r in dead_letters(spark, path).collect()}
    assert failed == {(3, "KeyError", 0), (5, "ZeroDivisionError", 0), (17, "ArrowInvalid", 1)}
    assert json.loads(dead_letters(spark, path).filter("batch = 1").first().record) == {"id": 17, "d": 2, "m": {"a": None}, "s": {"x": 17}}


def test_callbacks_that_return_nothing(spark, tmp_path):
    each_record(lambda r: 1 // r["id"], str(tmp_path / "out"))(spark.range(10), 4)
    assert [(r.record, r.batch) for r in dead_letters(spark, str(tmp_path / "out")).collect()] == [('{"id":0}', 4)]


def test_summary_stream_equals_the_batch_summary(spark, table, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    table.unionByName(end_mark(table), allowMissingColumns=True).coalesce(1).write.parquet(source)
    stream = flow_summary_stream(tables.stream_packets(spark, source, schema=table.schema))
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/d")
    )
    query.awaitTermination()
    assert closed_sessions(spark.read.parquet(f"{folder}/d")) == closed_sessions(flows.flow_summary(table))


def test_late_packets_are_set_aside_and_the_rest_is_never_dropped(spark, table, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    held = F.col("packet_id") % 20 == 0
    start = lambda: part_late(tables.stream_packets(spark, source, schema=table.schema, maxFilesPerTrigger=1), folder, 10.0, trigger={"availableNow": True})
    for part in batches(table.filter(~held), 2):
        part.coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()
    table.filter(held).coalesce(1).write.mode("append").parquet(source)
    start().awaitTermination()
    latest = table.filter(~held).agg(F.max("ts_us")).first()[0]
    is_late = held & (F.col("ts_us") + 60_000_000 <= latest - 10_000_000)
    late = late_packets(spark, folder, table.schema)
    assert rows(late.drop("batch")) == rows(table.filter(is_late)) and {r.batch for r in late.collect()} == {2}
    counts = late_counts(spark, folder).collect()
    assert [r.late for r in counts] == [0, 0, late.count()] and sum(r.in_time + r.late for r in counts) == table.count()
    assert max(r.latest_us for r in counts) == table.agg(F.max("ts_us")).first()[0]


def test_scoring_a_stream(spark, table, tmp_path):
    features = extract_features(table).withColumn("label", F.when(F.col("packet_length") > 700, "DDOS").otherwise("BENIGN")).cache()
    model = create_model("random_forest", n_estimators=3, max_depth=3).fit(features, row_id="packet_id")
    features.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(features.schema).parquet(str(tmp_path / "in"))
    out = score(stream, model, now=F.lit(1.0), keep=("packet_id",))
    query = (
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    expected = score(features, model, now=F.lit(1.0), keep=("packet_id",))
    as_text = lambda df: df.withColumn("class_probabilities", F.to_json("class_probabilities"))
    assert rows(as_text(spark.read.parquet(str(tmp_path / "out")))) == rows(as_text(expected))


def test_packets_from_json_messages(spark):
    message = '{"packet_id":1,"src_ip":"a","dst_ip":"b","protocol":"TCP","length":5,"ts_us":7}'
    got = tables.packets_from_json(spark.createDataFrame([(message,)], "value string")).first()
    assert (got.packet_id, got.src_ip, got.length, got.ts_us, got.ttl) == (1, "a", 5, 7, None)


def test_parted_packets_lie_in_files_of_bounded_size(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "FILE_ROWS", 100)
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    table.coalesce(1).write.parquet(source)
    part_late(tables.stream_packets(spark, source, schema=table.schema), folder, trigger={"availableNow": True}).awaitTermination()
    parted = spark.read.schema(table.schema).parquet(f"{folder}/parted")
    sizes = [r["count"] for r in parted.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 100 and sum(sizes) == table.count()


def test_the_late_stream_is_written_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "FILE_ROWS", 150)
    monkeypatch.setattr(storage, "work_folder", lambda session, name: str(tmp_path / name))
    spark.range(2_000).selectExpr(
        "id AS event_id", "timestamp_micros(1704067200000000 + id * 1000000000) AS ts", "id % 40 AS user_id", "'click' AS event_type", "1.0D AS value"
    ).coalesce(1).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    fates = {r.fate: r.packets for r in queries.late_packets_stream(spark, str(tmp_path / "sf")).filter("packet_id IS NULL").collect()}
    usable = 2_000 - len([i for i in range(2_000) if i % 997 == 0])
    assert fates["late, counted"] > 0 and sum(fates.values()) == usable
    written = spark.read.parquet(str(tmp_path / "late-packets-stream" / "packets"))
    assert written.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 150
