import os
import random

import pytest
from pyspark.sql import functions as F
from test_sessions import T0, busy_table
from test_streaming import batches, closed_sessions, rows

from wiretide.operators import flows
from wiretide.plans.extract import extract_features
from wiretide.schemas import MICROS, PACKET_SCHEMA
from wiretide.streaming import store as log
from wiretide.streaming.flows import Progress
from wiretide.streaming.store import RECORD_SCHEMA, FlowStore, Manifest, Merge, Run, Totals, buckets_for, choose_merge, size_class


def written(folder):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith((".parquet", ".json"))}


def test_many_small_batches_with_merges_give_the_batch_rows(spark, tmp_path, monkeypatch):
    # Sizes so small that buckets, size classes and both kinds of merges come up.
    monkeypatch.setattr(log, "BUCKET_ROWS", 4)
    chosen = []

    def choose(manifest):
        runs = manifest.runs
        chosen.append(Merge(runs, True) if len(runs) > 3 else Merge(runs[1:], False) if len(runs) == 3 else None)
        return chosen[-1]

    monkeypatch.setattr(log, "choose_merge", choose)
    table = busy_table(spark, 700).cache()
    store, features, closed = FlowStore(spark, str(tmp_path / "state")), [], []
    progress = Progress(store)
    parts = batches(table, 8)
    for i, part in enumerate(parts):
        progress.take(part, i, lambda df, _: features.extend(rows(df)), lambda df, _: closed.extend(closed_sessions(df)))
        if i % 4:
            store.wait()
        if i == 6:
            progress = Progress(FlowStore(spark, store.folder))
            store = progress.store
    store.wait()
    assert sorted(features, key=repr) == rows(extract_features(table))
    end = table.agg(F.max("ts_us")).first()[0]
    summary = flows.flow_summary(table)
    over = F.lit(end) - F.col("last_seen_us") > 60 * MICROS
    assert sorted(closed) == closed_sessions(summary.filter(over))
    left_open, totals = store.before(99)
    assert closed_sessions(left_open) == closed_sessions(summary.filter(~over)) and totals.flows == summary.count()
    merges = [m for m in chosen if m]
    assert any(m.full for m in merges) and any(not m.full for m in merges)
    # Nothing is left but what the kept manifests name, and perhaps the last merge.
    assert len(store.versions()) == log.KEPT_VERSIONS
    manifest = store.manifest_before(99)
    assert len(manifest.runs) < len(parts) and all(s * log.SLOT_US > end - 60 * MICROS - log.SLOT_US for s, _ in manifest.index)
    assert len(os.listdir(f"{store.folder}/runs")) <= sum(len(store._read_manifest(v).runs) for v in store.versions()) + 1


@pytest.fixture(scope="module")
def million(spark):
    """A million open flows between addresses of their own, last seen at different times."""
    n = 1_000_000
    record = {
        "flow_hash": F.xxhash64("id"), "flow_id": F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 16), "session": F.lit(1).cast("bigint"),
        "endpoint_1_ip": F.concat(F.lit("10.0."), F.col("id").cast("string")), "endpoint_2_ip": F.lit("10.9.9.9"), "protocol": F.lit("TCP"),
        "start_us": F.lit(T0), "last_seen_us": F.lit(T0) + F.col("id") * 55, "total_packets": F.lit(2).cast("bigint"), "total_bytes": F.lit(100).cast("bigint"),
    }
    made = spark.range(n).select(*[record.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])
    return made, Totals(0, n, T0 + n * 55)


def test_a_small_batch_reads_and_writes_little_of_a_million_open_flows(spark, million, tmp_path):
    store = FlowStore(spark, str(tmp_path / "state"))
    store.import_flows(*million)
    base = sum(written(store.folder).values())
    run = store.manifest_before(1).runs[0]
    assert run.rows == 1_000_000 and run.buckets == 256
    progress, opened = Progress(store), []
    leaves = store._leaves
    store._leaves = lambda runs, wanted: opened.append(leaves(runs, wanted)) or opened[-1]
    packet = lambda i, t, port: (i, "10.0.0.1", "10.0.0.2", port, 443, "TCP", 60, t, None, "A", None, None)
    now = T0 + 55 * MICROS
    for batch in range(1, 6):
        before = written(store.folder)
        # Ten flows; the first batches come before any of the million runs out, the fourth after a hundredth did.
        now += {4: 4 * MICROS, 5: 1}.get(batch, MICROS)
        packets = [packet(batch * 100 + i, now + i, 5000 + i) for i in range(10)]
        closed = []
        progress.take(spark.createDataFrame(packets, PACKET_SCHEMA), batch, None, lambda df, _: closed.append(df.count()))
        new = {p: n for p, n in written(store.folder).items() if p not in before}
        if batch != 4:
            assert closed == [0] and sum(new.values()) < base / 200, batch
            assert len([p for p in opened[-1] if run.path in p]) <= 10
        else:
            # Last seen before the horizon: ids below (now + 9 - 60 s - T0) / 55.
            gone = -(-(now + 9 - 60 * MICROS - T0) // 55)
            assert closed == [gone] and 30_000 < gone < 60_000 and sum(new.values()) < base / 5
    left, totals = store.before(99)
    assert left.count() == 1_000_000 - gone + 10 and totals.flows == 1_000_010
    assert left.filter("endpoint_2_port = 5000 or endpoint_1_port = 5000").first().total_packets == 5
    assert store.wait() is None


def test_merges_are_chosen_by_size():
    run = lambda n: Run(f"r{random.random()}", n, buckets_for(n), (0,))
    small, large = [run(10) for _ in range(4)], [run(1_000_000), run(900_000)]
    assert choose_merge(Manifest()) is None
    assert choose_merge(Manifest((*small[:3], *large), merged=10**6)) is None
    found = choose_merge(Manifest((*large, *small), merged=10**6))
    assert set(found.runs) == set(small) and not found.full
    assert choose_merge(Manifest(tuple(small), merged=10**6)).full
    assert choose_merge(Manifest((*large, *small), merged=10**6, added=10**6)).full
    assert [buckets_for(n) for n in (0, 1, 4096, 4097, 10_000, 10**6, 10**9)] == [1, 1, 1, 2, 4, 256, 4096]
    assert [size_class(n) for n in (1, 4096, 4 * 4096, 16 * 4096, 10**6)] == [0, 0, 1, 2, 4]


def test_a_failed_merge_changes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "MERGED_RUNS", 2)
    monkeypatch.setattr(FlowStore, "_merged", lambda *_: 1 / 0)
    table = busy_table(spark, 300).cache()
    progress = Progress(FlowStore(spark, str(tmp_path / "state")))
    for i, part in enumerate(batches(table, 4)):
        progress.take(part, i)
        progress.store.wait()
    end = table.agg(F.max("ts_us")).first()[0]
    assert closed_sessions(progress.store.before(99)[0]) == closed_sessions(flows.active_flows(table, end))
    assert len(progress.store.manifest_before(99).runs) == 4


def test_empty_batches_and_a_store_that_is_new(spark, tmp_path):
    progress = Progress(FlowStore(spark, str(tmp_path / "state")))
    assert progress.store.before(0) == (None, Totals())
    nothing = busy_table(spark, 50).limit(0)
    for i in range(2):
        progress.take(nothing, i)
    assert progress.store.before(9)[0] is None and progress.store.manifest_before(9).runs == ()
    table = busy_table(spark, 50)
    progress.take(table, 2)
    progress.take(nothing, 3)
    end = table.agg(F.max("ts_us")).first()[0]
    assert closed_sessions(progress.store.before(9)[0]) == closed_sessions(flows.active_flows(table, end))
