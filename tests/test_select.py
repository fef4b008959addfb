import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wiretide.functions import threat
from wiretide.operators import select, split
from wiretide.operators.split import with_split


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()[:16]


@pytest.mark.parametrize("spread", [1, 7, 10**13])
def test_the_first_rows_of_an_order_are_found_for_any_number(spark, monkeypatch, spread):
    monkeypatch.setattr(select, "RANGES", 5)
    # Ties in the value, in the key too, and one value that holds a third of all rows.
    rows = [((i * i % 31 if i % 3 else 17) * spread - 40, key(i % 50), i) for i in range(300)]
    table = spark.createDataFrame(rows, "v long, k string, s long").repartition(4)
    ordered = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    for n in (0, 1, 5, 40, 150, 299, 300, 1_000) if spread == 7 else (40, 133):
        got = select.largest_rows(table, n, "v", "k", "s", task_rows=3)
        assert [tuple(r) for r in got.collect()] == ordered[:n], n


def test_no_task_gets_all_rows_of_a_long_list(spark):
    table = spark.range(1_000).selectExpr("id AS v", "CAST(id AS string) AS k", "id AS s")
    text = select.largest_rows(table, 500, "v", "k", "s", task_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "TakeOrdered" not in text


def plain_cuts(rows, size, seed):
    of_class = defaultdict(list)
    for i, y in rows:
        if y is not None:
            of_class[y].append((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    return {i for drawn in of_class.values() for _, i in sorted(drawn)[: math.floor(len(drawn) * size + 0.5)]}


@pytest.mark.parametrize("literal", [1_000, 2], ids=["in the plan", "joined"])
def test_large_buckets_are_counted_by_further_digits(spark, monkeypatch, literal):
    monkeypatch.setattr(split, "LITERAL_CLASSES", literal)
    monkeypatch.setattr(split, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(split, "BUCKET_ROWS", 2)
    rows = [(i, [None, "a", "b", "c", "d"][min(i % 7, 4)] if i else "alone") for i in range(900)]
    table = spark.createDataFrame(rows, "id long, y string").withColumns({"_label": F.lit(1), "extra.dot": F.lit(2)})
    for size in (0.0, 0.2, 0.5, 1.0):
        marked = with_split(table, "y", "id", size, 5)
        assert marked.columns == [*table.columns, "split"]
        got = marked.select("id", "split").collect()
        assert len(got) == len(rows) and {r.id for r in got if r.split == "test"} == plain_cuts(rows, size, 5), size


def test_a_split_by_very_many_classes(spark):
    table = spark.range(300_000).selectExpr("id", "id % 100000 AS y")
    marked = with_split(table, "y", "id", 0.34)
    counts = marked.groupBy("y").agg(F.count_if(F.col("split") == "test").alias("n")).groupBy("n").count().collect()
    assert [(r.n, r["count"]) for r in counts] == [(1, 100_000)]


def test_bands_and_weights_from_tables(spark):
    rows = spark.createDataFrame([(1, -5.0, "A"), (2, 10.0, "B"), (3, 10.5, "C"), (4, 99.0, None), (5, None, "A"), (6, 300.0, "A")], "id long, confidence double, category string")
    bands = spark.createDataFrame([("low", 10.0), ("mid", 50.0), ("also mid", 50.0), ("none", None)], "name string, upper double")
    got = {r.id: r.severity for r in threat.with_severity_from_table(rows, bands).collect()}
    assert got == {1: "low", 2: "low", 3: "also mid", 4: "also mid", 5: None, 6: "also mid"}
    for bad in (bands.limit(0), spark.range(1_001).selectExpr("'x' AS name", "CAST(id AS double) AS upper")):
        with pytest.raises(ValueError, match="bands"):
            threat.with_severity_from_table(rows, bad)
    weights = spark.createDataFrame([("A", 0.5), ("A", 0.25), ("B", 2.0), (None, 9.0)], "category string, weight double")
    risky = threat.with_risk_from_table(rows.withColumn("weight", F.lit("mine")), weights, 0.1)
    assert risky.columns == ["id", "confidence", "category", "weight", "risk_score"]
    assert {r.id: r.risk_score for r in risky.collect()} == {1: 0.0, 2: 20.0, 3: pytest.approx(1.05), 4: pytest.approx(9.9), 5: None, 6: 50.0}
