"""How often rows are dealt out anew where the session keeps all shuffle partitions, and links joined to components."""

import numpy as np
import pytest
from test_operators import components, plain_near, rows

from wiretide.llm import cover_tree, near_duplicates
from wiretide.llm.common import ship_package
from wiretide.llm.components import connected_components
from wiretide.sources import storage

HELD = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def held(spark):
    before = {k: spark.conf.get(k) for k in HELD}
    for k, v in HELD.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def tasks(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return found, sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))


def shuffled(spark):
    """Bytes of the shuffles that lie on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()))


def table(seed):
    """Clusters of near copies, some of which link only with each other, exact copies, and texts that share lines."""
    rng, out = np.random.default_rng(seed), []
    for i in range(260):
        w = [f"w{i % 6}_{j}" for j in range(90)]
        for j in rng.choice(90, int(rng.integers(0, 14)), replace=False):
            w[j] = f"x{i % 50}_{j}"
        out.append((i, " ".join(w)))
    return out + [(260 + i, out[i][1]) for i in range(20)]


def test_near_duplicates_deals_rows_out_seldom(held):
    data = table(3)
    df = held.createDataFrame(data, "doc_id long, text string").repartition(8).persist()
    df.count()
    got, n = tasks(held, "near-duplicates", lambda: {r["doc_id"]: r["component_id"] for r in rows(near_duplicates.near_duplicates(df, 2))})
    df.unpersist()
    assert got == plain_near(data)[1]
    assert n < 65 * int(HELD["spark.sql.shuffle.partitions"]), n


@pytest.mark.parametrize("seed", range(3))
def test_components_of_paths_hubs_and_repeated_links(spark, seed):
    rng = np.random.default_rng(seed)
    path = rng.permutation(40).tolist()
    links = [*zip(path, path[1:]), *((100, 200 + i) for i in range(50)), *((300 + i, 150) for i in range(50))]
    links += [tuple(x) for x in rng.integers(400, 460, (45, 2)).tolist()] + [(500, 500)]
    # A dense part, whose links outnumber its nodes, and every link twice.
    links += [tuple(x) for x in rng.integers(600, 640, (400 * (seed % 2), 2)).tolist()]
    links = [*links, *((b, a) for a, b in links)]
    between = [(a, b) for a, b in links if a != b]
    want = components({x for pair in between for x in pair}, between)
    found = rows(connected_components(spark.createDataFrame(links, "a long, b long")))
    assert len(found) == len(want) and {r["node"]: r["component"] for r in found} == want


def test_components_of_no_links(spark):
    assert rows(connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"))) == []


def test_vectors_are_written_few_times_and_never_once_a_pair_of_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 50)
    kept = tmp_path / "kept"
    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(kept))
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(3_000, 64)).astype(np.float32) + 2
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(4)
    storage.collect_garbage(spark)
    before = shuffled(spark)
    found = cover_tree.near_vectors(rows, cosine=0.9).orderBy("vec_id").collect()
    unit = vectors.astype(np.float64)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    assert [r.n_links for r in found] == ((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist()
    assert sum(r.n_links for r in found) > 100
    written = sum(f.stat().st_size for f in kept.rglob("*") if f.is_file())
    assert written < 3 * vectors.nbytes
    assert written + shuffled(spark) - before < 8 * vectors.nbytes
