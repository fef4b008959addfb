import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wiretide import DetectionConfig
from wiretide.operators import encode, evaluate, packets, split
from wiretide.operators.split import with_split
from wiretide.plans.score import assess, score
from wiretide.plans.train import create_model, register_model, random_forest, split_and_train
from wiretide.plans.train import evaluate as evaluate_model
from wiretide.schemas import FEATURE_ORDER, NUMERIC_FEATURES, PREDICTION_SCHEMA
from wiretide.sources import storage, tables
from wiretide.sources.models import load_pipeline, model_exists

# One row per class: packet_length, total_bytes, packet_rate, protocol, direction, state.
EXAMPLES = {
    "BENIGN": (500.0, 5000.0, 5.0, "TCP", "OUTBOUND", "ESTABLISHED"),
    "PORT_SCAN": (60.0, 60.0, 200.0, "TCP", "INBOUND", "NEW"),
    "DDOS": (1200.0, 900000.0, 5000.0, "UDP", "INBOUND", "STATELESS"),
    "BRUTE_FORCE": (120.0, 8000.0, 40.0, "TCP", "INBOUND", "CLOSED"),
    "DATA_EXFILTRATION": (1400.0, 5000000.0, 300.0, "TCP", "OUTBOUND", "CLOSING"),
}


def training_table(spark, copies=12):
    rows = []
    for label, (length, total, rate, protocol, direction, state) in EXAMPLES.items():
        # The first class is rarer than the others.
        for i in range(copies if label != "BENIGN" else copies // 2):
            rows.append((len(rows), label, length + i, total + i, rate, protocol, direction, state, f"flow{len(rows)}"))
    schema = "id long, label string, packet_length double, total_bytes double, packet_rate double, protocol string, direction string, connection_state string, flow_id string"
    df = spark.createDataFrame(rows, schema)
    return encode.complete_inputs(df, "id", "label", "flow_id")


@pytest.fixture(scope="module")
def trained(spark):
    return create_model("random_forest", n_estimators=8, max_depth=5).fit(training_table(spark), row_id="id")


def test_model_names(spark):
    model = create_model("random_forest", n_estimators=10)
    assert model.name == "random_forest" and not model.is_trained
    with pytest.raises(ValueError, match="reserved"):
        create_model("xgboost")
    with pytest.raises(ValueError, match="unknown"):
        create_model("non_existent_model")
    register_model("small_forest", lambda **kw: random_forest(n_estimators=2, max_depth=2, **kw))
    assert create_model("small_forest").name == "small_forest"


def test_untrained_model_is_an_error_at_once(spark):
    model = create_model("random_forest")
    table = training_table(spark)
    for use in (lambda: model.classes, lambda: score(table, model), lambda: model.predict(table), lambda: evaluate_model(model, table)):
        with pytest.raises(ValueError, match="not been trained"):
            use()


def test_fit_and_score(spark, trained):
    assert trained.is_trained and trained.classes == sorted(EXAMPLES)
    table = training_table(spark)
    proba = trained.predict_proba(table).select("label", "predicted", "probabilities").collect()
    assert all(r.label == r.predicted for r in proba)
    assert all(len(r.probabilities) == 5 and math.isclose(sum(r.probabilities), 1.0) for r in proba)
    out = score(table, trained, now=F.lit(7.0), keep=("id",))
    assert out.columns == ["id", *PREDICTION_SCHEMA.fieldNames()]
    for r in out.collect():
        assert 0 <= r.confidence_score <= 100 and 0 <= r.risk_score <= 100
        assert r.model_name == "random_forest" and r.prediction_timestamp == 7.0 and r.flow_id.startswith("flow")
        assert set(r.class_probabilities) == set(EXAMPLES)
        assert r.confidence_score == max(r.class_probabilities.values()) * 100.0
        assert (r.threat_label == "BENIGN") == (r.attack_category == "BENIGN")
    stamp = score(table, trained).first().prediction_timestamp
    assert stamp > 1_700_000_000


def test_same_rows_give_the_same_forest(spark, trained):
    shuffled = training_table(spark).repartition(5, "packet_rate")
    again = create_model("random_forest", n_estimators=8, max_depth=5).fit(shuffled, row_id="id")
    assert again.pipeline.stages[-2].toDebugString.split("\n")[1:] == trained.pipeline.stages[-2].toDebugString.split("\n")[1:]


def test_rows_that_cannot_be_scored_are_set_aside(spark, trained):
    table = training_table(spark)
    broken = table.withColumn("ttl", F.when(F.col("id") == 3, float("nan")).when(F.col("id") == 4, float("inf")).otherwise(F.col("ttl")))
    good, bad = encode.split_scorable(broken)
    assert {r.id: r.error for r in bad.collect()} == {3: "ttl is not finite", 4: "ttl is not finite"}
    assert score(broken, trained).count() == good.count() == table.count() - 2


def test_a_two_class_model_can_be_used_after_rows_were_counted(spark, tmp_path):
    two = training_table(spark).filter(F.col("label").isin("DDOS", "BENIGN")).cache()
    model = create_model("random_forest", n_estimators=2, max_depth=2).fit(two, row_id="id")
    assert not model.pipeline.stages[-2].hasSummary
    tables.write_features_csv(two, str(tmp_path / "out"))
    assert score(two, model).count() == two.count()


def test_save_and_load(spark, trained, tmp_path):
    path = str(tmp_path / "sub" / "model")
    assert not model_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        load_pipeline(spark, path)
    trained.save(path)
    assert model_exists(spark, path)
    copy = create_model("random_forest").load(spark, path)
    assert copy.is_trained and copy.classes == trained.classes
    table = training_table(spark)
    before = trained.predict_proba(table).orderBy("id").select("predicted", "probabilities").collect()
    assert copy.predict_proba(table).orderBy("id").select("predicted", "probabilities").collect() == before


def test_first_of_equal_probabilities_wins(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.45, 0.45],), ([0.0, 0.0, 1.0],)], "p array<double>")
    columns = assess(F.col("p"), ["BENIGN", "DDOS", "WORM"], "m", DetectionConfig())
    out = df.select(*[columns[c].alias(c) for c in ("attack_category", "confidence_score")]).collect()
    assert [tuple(r) for r in out] == [("BENIGN", 40.0), ("DDOS", 45.0), ("UNKNOWN", 100.0)]


def test_an_encoding_of_ones_own_is_saved_with_the_model(spark, tmp_path):
    short = VectorAssembler(inputCols=["packet_length", "packet_rate"], outputCol="_vector")
    model = create_model("random_forest", encoding=[short], n_estimators=3, max_depth=3).fit(training_table(spark), row_id="id")
    model.save(str(tmp_path / "m"))
    copy = create_model("random_forest").load(spark, str(tmp_path / "m"))
    assert copy.pipeline.stages[-2].numFeatures == 2
    assert copy.predict(training_table(spark)).count() == training_table(spark).count()


def test_encoding(spark):
    row = {c: 1.0 for c in NUMERIC_FEATURES} | {"protocol": "udp", "direction": "INTERNAL", "connection_state": "weird"}
    df = spark.createDataFrame([row, row])
    coded = encode.encode(encode.select_inputs(df))
    assert coded.columns == list(FEATURE_ORDER) and coded.count() == 2
    assert coded.first()[-3:] == (1.0, 2.0, 5.0)
    with pytest.raises(ValueError, match="ttl"):
        encode.select_inputs(df.drop("ttl"))
    # The saved stages give the same numbers.
    staged = df.withColumn("ttl", F.lit(None).cast("double"))
    for stage in encode.encoding_stages():
        staged = stage.transform(staged)
    expected = list(coded.first())
    expected[FEATURE_ORDER.index("ttl")] = 0.0
    assert list(staged.first()["_vector"]) == expected
    assert not [c for c in staged.columns if c.startswith("_in_")]


def test_split_keeps_class_shares_exactly(spark):
    # One class holds nearly all rows.
    df = spark.range(5000).withColumn("y", F.when(F.col("id") % 50 == 0, "a").when(F.col("id") % 50 == 1, "b").otherwise("c"))
    marked = split.with_split(df, "y", "id", 0.25, 7)
    counts = {(r.y, r.split): r["count"] for r in marked.groupBy("y", "split").count().collect()}
    assert counts == {("a", "test"): 25, ("a", "train"): 75, ("b", "test"): 25, ("b", "train"): 75, ("c", "test"): 1200, ("c", "train"): 3600}
    again = split.with_split(df.repartition(3), "y", "id", 0.25, 7)
    assert marked.exceptAll(again).count() == 0
    other = split.with_split(df, "y", "id", 0.25, 8)
    assert marked.exceptAll(other).count() > 0


def test_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("a", "d")]
    df = spark.createDataFrame(pairs, "y_true string, y_pred string")
    table = {r.label: r for r in evaluate.per_class(df).collect()}
    assert (table["a"].precision, table["a"].recall, table["a"].support) == (0.75, 0.6, 5)
    assert (table["c"].precision, table["c"].recall, table["c"].f1, table["c"].support) == (0.0, 0.0, 0.0, 1)
    assert (table["d"].precision, table["d"].recall, table["d"].support) == (0.0, 0.0, 0)
    m = evaluate.metrics(df).first()
    assert m.accuracy == 5 / 8
    assert m.precision_macro == pytest.approx((0.75 + 2 / 3) / 4)
    assert m.f1_macro == pytest.approx((2 / 3 + 0.8) / 4)
    report = evaluate.classification_report(df)
    lines = {r.label: r for r in report.collect()}
    assert lines["weighted avg"].recall == pytest.approx(5 / 8) and lines["macro avg"].support == 8
    text = evaluate.report_text(report)
    assert [line.split()[0] for line in text.split("\n") if line.strip()] == ["precision", "a", "b", "c", "d", "accuracy", "macro", "weighted"]
    assert evaluate.metrics(df.limit(0)).first().accuracy == 0.0


def test_train_and_evaluate_from_csv(spark, tmp_path):
    path = str(tmp_path / "data.csv")
    with open(path, "w") as out:
        out.write("packet_length,flow_duration,protocol, Label ,other\n")
        out.write("60,0.1,TCP,benign,x\n60,n/a,TCP,BENIGN,x\n1500,5.0,UDP,ddos,x\n1500,5.0,UDP,DDoS,x\n")
    df = tables.read_labelled_csv(spark, path, "Label").cache()
    assert df.columns == ["row_id", *FEATURE_ORDER, "label"] and df.count() == 4
    assert sorted(r.label for r in df.collect()) == ["BENIGN", "BENIGN", "DDOS", "DDOS"]
    assert sorted(r.flow_duration for r in df.collect()) == [0.0, 0.1, 5.0, 5.0]
    assert {r.direction for r in df.collect()} == {"UNKNOWN"} and {r.ttl for r in df.collect()} == {0.0}
    model = create_model("random_forest", n_estimators=10)
    train, test = split_and_train(model, df, "row_id", test_size=0.5)
    assert train.count() == test.count() == 2
    totals, report = evaluate_model(model, test)
    assert totals.columns == ["accuracy", "precision_macro", "recall_macro", "f1_macro"]
    assert {"accuracy", "macro avg", "weighted avg"} <= {r.label for r in report.collect()}


def test_csv_errors_and_mapping(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_labelled_csv(spark, str(tmp_path / "none.csv"))
    path = str(tmp_path / "d.csv")
    with open(path, "w") as out:
        out.write("a,b\n")
    with pytest.raises(ValueError, match="no rows"):
        tables.read_labelled_csv(spark, path)
    with open(path, "w") as out:
        out.write(" Flow Duration,cls\n3,ddos\nNaN,x\n")
    with pytest.raises(ValueError, match="label"):
        tables.read_labelled_csv(spark, path)
    # The mapping names headers as they stand in the file.
    got = tables.read_labelled_csv(spark, path, "label", {" Flow Duration": "flow_duration", "cls": "label"})
    assert sorted((r.flow_duration, r.label) for r in got.collect()) == [(0.0, "UNKNOWN"), (3.0, "DDOS")]
    missed = tables.read_labelled_csv(spark, path, "cls", {"Flow Duration": "flow_duration"})
    assert {r.flow_duration for r in missed.collect()} == {0.0}


def test_feature_csv(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(3).select(F.lit("x").alias("b"), F.col("id").alias("a"), F.create_map(F.lit("k"), F.lit("v")).alias("extra"))
    assert tables.write_features_csv(df, path) == 3
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["a", "b", "extra"]
    assert tables.write_features_csv(df.limit(0), path) == 0
    assert spark.read.option("header", True).csv(path).count() == 3


def test_quoted_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ttl,protocol,label\n5,"TC""P","a\nddos"\n7,UDP,benign\n')
    rows = tables.read_labelled_csv(spark, str(tmp_path / "a.csv"), multi_line=True).orderBy("ttl").collect()
    assert len(rows) == 2 and rows[0]["protocol"] == 'TC"P'


def test_unreadable_optional_fields_go_to_the_dead_letters(spark):
    table = spark.createDataFrame(
        [(1, {"ttl": "64.x"}), (2, {"ttl": "64"}), (3, {"payload_size": None}), (4, {"payload_size": "many"})], "packet_id long, extra map<string,string>"
    ).selectExpr("*", "'1.1.1.1' src_ip", "'2.2.2.2' dst_ip", "100L length", "1L ts_us", "'UDP' protocol")
    usable, rejected = packets.split_valid(table)
    assert {r["packet_id"]: r["error"] for r in rejected.collect()} == {1: "ttl is unreadable", 4: "payload_size is unreadable"}
    assert {r["packet_id"]: r["ttl"] for r in packets.with_metadata(usable).collect()} == {2: 64, 3: None}
    assert packets.with_metadata(table).count() == 4


def test_a_limit_takes_no_packets_without_a_time(spark):
    table = spark.createDataFrame([(1, None), (2, 5), (3, 1)], "packet_id long, ts_us long")
    assert [r["packet_id"] for r in packets.capture_limit(table, 2).orderBy("ts_us").collect()] == [3, 2]


def test_no_shared_folder_is_invented():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session())


def test_rows_without_a_label_are_never_test_rows(spark):
    table = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "a").alias("label"))
    marked = with_split(table, "label", "id").collect()
    assert sum(r["split"] == "test" for r in marked if r["label"]) == 10
    assert {r["split"] for r in marked if not r["label"]} == {"train"}


def test_union_of_different_rows(spark):
    left, right = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2.5, 2)], "c double, a int")
    assert sorted(tuple(r) for r in tables.union_rows(left, right).collect()) == [(1, "x", None), (2, None, 2.5)]


# data sets as CSV


def test_csv_rows_keep_their_identity_however_they_are_stored(spark, tmp_path):
    lines = [f"{i % 50},{i % 3},{['ddos', 'benign', 'botnet'][i % 7 % 3]}" for i in range(2_000)] + ["9,9,benign"] * 700
    for name, parts in (("one", 1), ("many", 9)):
        folder = tmp_path / name
        folder.mkdir()
        own = lines if parts == 1 else lines[::-1]
        for i in range(parts):
            (folder / f"{i}.csv").write_text("\n".join(["packet_length,ttl,label", *own[i::parts]]) + "\n")
    seen = []
    for name, size in (("one", "128m"), ("one", "4k"), ("many", "1k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            table = with_split(tables.read_labelled_csv(spark, str(tmp_path / name)), "label", "row_id")
            seen.append(sorted((r.row_id, r.split) for r in table.select("row_id", "split").collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] == seen[2] and len({i for i, _ in seen[0]}) == 2_700
    assert abs(sum(s == "test" for _, s in seen[0]) - 540) <= 2


def test_equal_rows_are_numbered_in_chunks(spark):
    table = spark.range(1_000).selectExpr("id % 3 AS a", "if(id % 3 = 1, null, 'z') AS b")
    for chunk in (1, 7, 100_000):
        got = tables.with_row_id(table, chunk)
        assert got.columns == ["row_id", "a", "b"] and got.select("row_id").distinct().count() == 1_000
        ids = [r.row_id.split("-") for r in got.collect()]
        assert sorted(int(n) for _, n in ids) == sorted([*range(334), *range(333), *range(333)])


def test_records_with_a_cell_too_many_or_too_few_are_rejected(spark, tmp_path):
    text = 'packet_length,ttl,label\n1,2,ddos\n3,4,5,6,ddos\n7,8\n"1,5",2,"x, ""y"""\n,,\n\n"a,b","c",1,2\n5,6,benign\n'
    (tmp_path / "a.csv").write_text(text)
    kept = tables.read_labelled_csv(spark, str(tmp_path))
    assert sorted((r.packet_length, r.ttl, r.label) for r in kept.collect()) == [(0.0, 0.0, "UNKNOWN"), (0.0, 2.0, "UNKNOWN"), (1.0, 2.0, "DDOS"), (5.0, 6.0, "BENIGN")]
    assert kept.count() == 4 and kept.select("label").distinct().count() == 3
    rejects = tables.rejected_csv_rows(spark, str(tmp_path))
    want = {("3,4,5,6,ddos", "5 cells in place of 3"), ("7,8", "2 cells in place of 3"), ('"a,b","c",1,2', "4 cells in place of 3")}
    assert {(r.record, r.error) for r in rejects.collect()} == want and rejects.count() == 3
    assert {r.file for r in rejects.collect()} == {"a.csv"}
    (tmp_path / "empty.csv").write_text("packet_length,label\n")
    with pytest.raises(ValueError, match="no rows"):
        tables.read_labelled_csv(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        tables.rejected_csv_rows(spark, str(tmp_path / "absent.csv"))
