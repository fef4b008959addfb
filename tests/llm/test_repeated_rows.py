"""Repeated ids, repeated rows and odd column names, in operators on pairs and through the whole pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import COPY, LONG, check_packing, components, rows

import corpus_pipeline
from wiretide.llm import cover_tree, mixing, near_duplicates
from wiretide.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def near(a, b, n=2):
    sets = []
    for text in (a, b):
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n, 0) + 1)} if w else set())
    return bool(sets[0]) and 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])


def texts(seed):
    """Few bases, copies and near copies of them, empty texts, under ids that repeat and some that are null."""
    rng, out = np.random.default_rng(seed), []
    for i in range(120):
        w = [f"b{int(rng.integers(0, 12))}_{j}" for j in range(1)] + [f"w{i % 9}_{j}" for j in range(40)]
        if rng.random() < 0.5:
            w[int(rng.integers(1, 41))] = f"x{i}"
        text = None if i % 31 == 0 else "" if i % 37 == 0 else " ".join(w)
        out.append((None if i % 29 == 0 else int(rng.integers(0, 60)), text))
    return out


def test_one_component_per_id_and_no_text_lost(spark):
    a, b = COPY, " ".join(f"other{i}" for i in range(60))
    table = spark.createDataFrame([(1, a), (5, a), (5, b), (6, b)], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in rows(near_duplicates.near_duplicates(table))} == {(1, 1), (5, 1), (6, 1)}
    assert sorted((r["doc_id"], r["text"]) for r in rows(near_duplicates.keep_one(table))) == [(1, a), (5, b)]
    # A near copy of A heads its group, under an id of its own or one that repeats.
    for first in (0, 5):
        more = table.union(spark.createDataFrame([(first, a + " y")], table.schema))
        kept = rows(near_duplicates.keep_one(more))
        assert len(kept) == 2 and sum(r["text"] == b for r in kept) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_ids_against_all_pairs(spark, seed):
    data = texts(seed)
    table = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    linked = [(x, y) for i, (x, s) in enumerate(data) for y, t in data[i + 1 :] if x is not None and y is not None and near(s, t)]
    want = components({x for x, _ in data if x is not None}, linked)
    got = rows(near_duplicates.near_duplicates(table, 2))
    assert len(got) == len(data)
    assert all(r["component_id"] == want.get(r["doc_id"]) and r["kept"] == (r["doc_id"] in (None, r["component_id"])) for r in got)
    # The stage: rows are the nodes, whatever their ids are.
    group = components(range(len(data)), [(i, j) for i in range(len(data)) for j in range(i) if near(data[i][1], data[j][1])])
    members = {}
    for i, g in group.items():
        members.setdefault(g, []).append(data[i])
    kept = [(r["doc_id"], r["text"]) for r in rows(near_duplicates.keep_one(table.withColumn("dropped", F.lit(1)), 2))]
    assert len(kept) == len(members)
    order = lambda d: (d is None, d)
    assert sorted(map(order, (d for d, _ in kept))) == sorted(min(order(d) for d, _ in m) for m in members.values())
    assert all(any(near(t, k) or t == k for _, k in kept) or any(near(t, s) for _, s in data) for _, t in data)


def test_repeated_ids_of_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(5, 8))
    data = [(int(rng.integers(0, 40)), (base[i % 5] + rng.normal(size=8) * (0.02 if i % 2 else 1.5)).tolist() if i % 11 else None, i % 2) for i in range(90)]
    data += data[:7]
    unit = [(i, np.array(v) / np.linalg.norm(v), y) for i, v, y in data if v is not None]
    want = components({i for i, _, _ in data}, [(a, b) for a, u, x in unit for b, v, y in unit if x == y and u @ v >= 0.93])
    got = rows(cover_tree.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")))
    assert len(got) == len(data) and all(r["component_id"] == want[r["vec_id"]] and r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_names_with_dots_and_quotes(spark):
    table = spark.createDataFrame([(1, "a b", "s"), (2, "c", None)], "doc_id long, text string, source string")
    odd = table.withColumn("a.b", F.lit("mine")).withColumn("c`d", F.lit(2))
    assert mixing.mix(odd).columns == odd.columns and {r["a.b"] for r in rows(mixing.mix(odd))} == {"mine"}
    assert near_duplicates.keep_one(odd).columns == odd.columns and len(rows(near_duplicates.keep_one(odd))) == 2
    named = table.withColumnsRenamed({"doc_id": "the.id", "text": "the.text", "source": "the.source"})
    assert len(rows(mixing.mix(named, "the.text", "the.source", "the.id"))) == len(rows(mixing.mix(table)))
    assert len(rows(near_duplicates.keep_one(named, id_col="the.id", text_col="the.text"))) == 2


def test_the_pipeline_takes_odd_tables(spark, tmp_path):
    plain = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    odd = [(None, plain[1][1], "en", None, None), (1, None, None, "a", 0), (2, "", "en", None, None), (plain[3][0], plain[4][1], None, "b", 1), plain[5], (3, LONG, "en", "a", None)]
    table = spark.createDataFrame([*plain, *odd], DOCS)
    for name in ("kept", "dropped", "row_number", "mix", "copy", "a.b"):
        table = table.withColumn(name, F.lit("mine"))
    table.write.parquet(str(tmp_path / "odd/documents.parquet"))
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "none/documents.parquet"))
    docs, given = spark.read.parquet(str(tmp_path / "odd/documents.parquet")), {t for _, t, *_ in [*plain, *odd]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path / "odd")), f"odd-{name}")
        assert docs.columns == table.columns and {r["a.b"] for r in rows(docs)} <= {"mine"}
        assert {r["text"] for r in rows(docs)} <= given
    mixed = [(r["doc_id"], r["text"]) for r in rows(docs)]
    assert len(mixed) > 10
    check_packing(mixed, rows(corpus_pipeline.run(spark, str(tmp_path / "odd"))))
    assert rows(corpus_pipeline.run(spark, str(tmp_path / "none"))) == []
