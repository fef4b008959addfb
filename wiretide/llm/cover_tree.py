"""Near-duplicate vectors by dual traversal of cover trees.

The vectors of a label are dealt into blocks around pivots, and a cover tree is built on
each block: nested levels of nodes with halving radii, every node knowing its exact
covering radius. Pairs of blocks, and then pairs of nodes level by level, are dropped
where the distance of their centers exceeds both covering radii and the threshold
distance, and taken whole where it plus both radii stays within it. What reaches the
bottom is compared in double precision, so the links are exact.

Vectors are written three times, in the type they came in: as points, placed, and in
blocks. All else goes by their keys, and pairs of blocks by name: a task reads the
blocks it compares from the shared folder.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wiretide.llm.common import row_pass
from wiretide.llm.components import connected_components
from wiretide.sources.storage import collect_garbage, delete, materialize, reached_by_path, work_folder

COSINE = 0.93
#: Vectors per block on average, and pivots per label, drawn by hash of the id.
BLOCK_ROWS, PIVOTS = 1_000, 64
#: Blocks in a file, which is read for each of them; pivots that are sent to all tasks.
BLOCKS_PER_FILE, SENT_PIVOTS = 8, 100_000
#: Vectors whose trees a task keeps, the last used ones.
TREE_BYTES = 32 << 20
#: Rounding of distances from inner products of unit vectors; pairs this near a bound go on to the bottom.
SLACK = 1e-7
LEVELS = 8


@dataclass
class Level:
    """Nodes of one level: the row at the center, the covering radius, the node above, the rows held."""

    center: np.ndarray
    radius: np.ndarray
    parent: np.ndarray
    weight: np.ndarray


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (left @ right.T), 0.0))


def build(vectors: np.ndarray, weights: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """Levels from one root to single rows, and the rows' nodes on each level (levels x rows).

    On a level with radius r a node's rows are covered by centers more than r apart, its
    own center first; a center stands again on all levels below.
    """
    n = len(vectors)
    owner = np.zeros(n, dtype=np.int64)
    root = distances(vectors, vectors[:1])[:, 0]
    levels = [Level(np.zeros(1, dtype=np.int64), np.array([root.max()]), np.zeros(1, dtype=np.int64), np.array([weights.sum()]))]
    owners = [owner]
    reach = max(float(root.max()), 1e-9)
    for depth in range(LEVELS):
        reach /= 2
        last = depth == LEVELS - 1
        above = levels[-1]
        order = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[order], np.arange(len(above.center) + 1))
        centers, parents, radii = [], [], []
        below = np.empty(n, dtype=np.int64)
        for node in range(len(above.center)):
            rows = order[bounds[node] : bounds[node + 1]]
            if len(rows) == 1 or last:
                below[rows] = len(centers) + np.arange(len(rows))
                centers += rows.tolist()
                parents += [node] * len(rows)
                radii += [0.0] * len(rows)
                continue
            start = above.center[node]
            while len(rows):
                d = distances(vectors[rows], vectors[start : start + 1])[:, 0]
                near = (d <= reach) | (rows == start)
                below[rows[near]] = len(centers)
                centers.append(start)
                parents.append(node)
                radii.append(float(d[near].max()) if near.sum() > 1 else 0.0)
                rows = rows[~near]
                start = rows[0] if len(rows) else start
        owner = below
        levels.append(Level(np.array(centers), np.array(radii), np.array(parents), np.bincount(owner, weights=weights, minlength=len(centers))))
        owners.append(owner)
        if len(centers) == n:
            break
    if len(levels[-1].center) < n:
        raise AssertionError("the last level holds single rows")
    return levels, np.stack(owners)


def dual_traversal(a: tuple, b: tuple, vectors_a: np.ndarray, vectors_b: np.ndarray, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, list]:
    """Weighted links of a's rows to b's and of b's to a's, and row pairs that join what is linked.

    same: a is b; then only the first result counts, each row's link with itself left out
    by the caller.
    """
    most = math.sqrt(2.0 - 2.0 * cosine)
    (levels_a, owners_a), (levels_b, owners_b) = a, b
    links_a, links_b, joined = np.zeros(len(vectors_a)), np.zeros(len(vectors_b)), []
    alive = np.ones((1, 1), dtype=bool)
    depth = max(len(levels_a), len(levels_b))
    for i in range(depth):
        ia, ib = min(i, len(levels_a) - 1), min(i, len(levels_b) - 1)
        la, lb = levels_a[ia], levels_b[ib]
        if i:
            pa_, pb_ = (la.parent if ia == i else np.arange(len(la.center))), (lb.parent if ib == i else np.arange(len(lb.center)))
            alive = alive[pa_][:, pb_]
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            break
        inner = vectors_a[la.center[rows]] @ vectors_b[lb.center[columns]].T
        live = alive[np.ix_(rows, columns)]
        reach = la.radius[rows][:, None] + lb.radius[columns][None, :]
        if i == depth - 1:
            taken = live & (inner >= cosine)
            live = np.zeros_like(live)
        else:
            d = np.sqrt(np.maximum(2.0 - 2.0 * inner, 0.0))
            taken = live & (d + reach <= most - SLACK)
            live &= ~taken & (d - reach <= most + SLACK)
        if taken.any():
            to_rows, to_columns = taken @ lb.weight[columns], la.weight[rows] @ taken
            full_a, full_b = np.zeros(len(la.center)), np.zeros(len(lb.center))
            full_a[rows], full_b[columns] = to_rows, to_columns
            links_a += full_a[owners_a[ia]]
            links_b += full_b[owners_b[ib]]
            # Everything below a taken node reaches one center of the other side.
            for k in np.flatnonzero(taken.any(axis=1)):
                met = columns[taken[k]]
                node = rows[k]
                joined.append((la.center[node], lb.center[met]))
                if la.radius[node] > 0 or (owners_a[ia] == node).sum() > 1:
                    below = np.flatnonzero(owners_a[ia] == node)
                    joined.append((below, np.full(len(below), lb.center[met[0]])))
            for k in np.flatnonzero(taken.any(axis=0)):
                node = columns[k]
                below = np.flatnonzero(owners_b[ib] == node)
                if len(below) > 1:
                    joined.append((np.full(len(below), la.center[rows[np.argmax(taken[:, k])]]), below))
        alive = np.zeros((len(la.center), len(lb.center)), dtype=bool)
        alive[np.ix_(rows, columns)] = live
    return links_a, links_b, joined


def _forest(joined: list, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most one link per id that joins what the pairs join."""
    if not joined:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    pairs = [np.broadcast_arrays(x, y) for x, y in joined]
    left, right = ids_a[np.concatenate([x for x, _ in pairs])], ids_b[np.concatenate([y for _, y in pairs])]
    nodes, where = np.unique(np.concatenate([left, right]), return_inverse=True)
    u, v = where[: len(left)], where[len(left) :]
    label = np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, u, label[v])
        np.minimum.at(least, v, label[u])
        least = least[least]
        if (least == label).all():
            break
        label = least
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def unit(vector: list | np.ndarray | None) -> np.ndarray | None:
    """The vector at length 1 in double precision; null where it has no direction."""
    if vector is None or not len(vector) or (isinstance(vector, list) and None in vector):
        return None
    v = np.array(vector, dtype=np.float64)
    largest = np.abs(v).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    # Scaled first, so that squares neither overflow nor vanish; no minus zeros, so that equal vectors are equal.
    v = v / largest
    return v / np.sqrt(v @ v) + 0.0


def _vectors(column: pa.Array) -> list:
    """The vectors of a column, as arrays where no component is null."""
    values, ends, there = column.values, column.offsets.to_numpy(), column.is_valid().to_pylist()
    if values.null_count:
        return column.to_pylist()
    values = values.to_numpy(zero_copy_only=False)
    return [values[a:b] if x else None for a, b, x in zip(ends[:-1], ends[1:], there)]


def _units(batch: pa.RecordBatch) -> list:
    """Each row's vector at length 1, none for a row that links with nothing."""
    ids, labels = batch.column(0).is_valid().to_pylist(), batch.column(2).is_valid().to_pylist()
    return [unit(v) if i and x else None for i, v, x in zip(ids, _vectors(batch.column(1)), labels)]


def _normalised(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(_units(batch), type=pa.list_(pa.float64())), batch.column(2)], names=["id", "v", "label"])


def _keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows as they are, with a key that equal vectors share; null where a row links with nothing."""
    keys = [None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in _units(batch)]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, type=pa.binary())], names=["id", "v", "label", "key"])


def _written(df: DataFrame, name: str, rows_per_file: int = 0) -> tuple[DataFrame, str]:
    """The table, written to the shared folder and read back, and where it lies."""
    path = work_folder(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.parquet(path), path


def read_block(folder: str, file: str, label: str, block: str, kind: str) -> tuple:
    """The ids, vectors and tree of a block."""
    from pyarrow import parquet

    store, path = reached_by_path(folder)
    table = parquet.read_table(f"{path}/{file}", columns=["label", "block", "ids", "weights", "vectors"], filesystem=store, partitioning=None)
    at = list(zip(table["label"].to_pylist(), table["block"].to_pylist())).index((label, block))
    ids, weights = (np.frombuffer(table[c][at].as_buffer(), t) for c, t in (("ids", "<i8"), ("weights", "<f8")))
    vectors = np.stack([unit(v) for v in np.frombuffer(table["vectors"][at].as_buffer(), kind).reshape(len(ids), -1)])
    return ids, vectors, build(vectors, weights)


def near_vectors(table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per row: the id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold a null or non-finite component, and those
    without a label, link with nothing; so do vectors of different lengths. Equal vectors
    of a label are one point with a weight, however many there are. Rows with one id are one
    node: they have one component, which joins what is near any of their vectors, and the
    links of all of them are counted for each.
    """
    vector = F.col(vector_col).cast("array<double>").alias("v")
    spark = table.sparkSession
    own = table.schema[vector_col].dataType
    kind, stored = ("float", "<f4") if isinstance(own, T.ArrayType) and isinstance(own.elementType, T.FloatType) else ("double", "<f8")
    vector = F.col(vector_col).cast(f"array<{kind}>").alias("v")
    table = table.select(F.col(id_col).cast("long").alias("id"), vector, F.col(label_col).cast("string").alias("label"))
    schema = f"id long, v array<{kind}>, label string"
    keyed = row_pass(table, _keyed, f"{schema}, key binary")
    group = F.when(F.col("key").isNotNull(), F.concat_ws("/", F.size("v"), "label")).alias("label")
    rows = materialize(keyed.select("id", group, "key"), "keys")
    points = keyed.filter(F.col("key").isNotNull()).select("id", "v", group, "key").groupBy("label", "key")
    points, written = _written(points.agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")), "points")

    # Blocks: the nearest of a label's pivots, cut by hash where one holds too many.
    draw = F.xxhash64(F.lit("pivot"), F.col("id"))
    sizes = points.groupBy("label").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK_ROWS)
    wanted = sizes.select("label", F.least(F.lit(PIVOTS), F.ceil(F.col("n") / BLOCK_ROWS)).cast("int").alias("wanted"), "n")
    # A share of each label that holds twice the wanted pivots; the smallest draws of it are taken.
    narrow = points.select("label", "key", "id")
    likely = narrow.join(wanted, "label").filter(F.pmod(draw, F.lit(1 << 30)) < F.least(F.lit(1.0), (2 * F.col("wanted") + 20) / F.col("n")) * (1 << 30))
    first = likely.groupBy("label").agg(F.min("wanted").alias("wanted"), F.sort_array(F.collect_list(F.struct(draw.alias("draw"), "key"))).alias("all"))
    chosen = first.select("label", F.explode(F.slice("all", F.lit(1), F.col("wanted"))).alias("one")).select("label", F.col("one.key").alias("key"))
    # At most one point in five hundred is a pivot.
    chosen = points.join(F.broadcast(chosen), ["label", "key"]).select("id", "v", "label")
    chosen = materialize(row_pass(chosen, _normalised, "id long, v array<double>, label string"), "pivots")
    pivots = chosen.groupBy("label").agg(F.collect_list(F.struct(F.col("id").alias("pivot"), F.col("v").alias("p"))).alias("pivots"))
    cosine_to = lambda p: F.aggregate(F.zip_with(p, F.col("v"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    # A label can hold most rows: its pivots are one row, so the join splits well.
    placed = points.join(F.broadcast(pivots) if chosen.count() <= SENT_PIVOTS else pivots, "label", "left").withColumn(
        "pivot", F.array_max(F.transform(F.coalesce("pivots", F.array()), lambda p: F.struct(cosine_to(p["p"]).alias("c"), p["pivot"].alias("pivot"))))["pivot"]
    )
    placed = materialize(placed.select("label", F.coalesce("pivot", F.lit(-1)).alias("pivot"), "key", "id", "weight", "v"), "placed")
    del points, narrow, likely, first
    delete(spark, written)
    collect_garbage(spark)
    points = placed.select("label", "key", "id", "weight")
    cells = placed.groupBy("label", "pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts")).filter("parts > 1")
    # Fewer than a thousandth of the points.
    dealt = placed.join(F.broadcast(cells), ["label", "pivot"], "left").withColumn("part", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))))

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        own = np.stack(_vectors(rows.column("v").combine_chunks()))
        vectors = np.stack([unit(v) for v in own])
        center = vectors.mean(axis=0)
        length = np.linalg.norm(center)
        center = center / length if length > 0 else vectors[0]
        radius = float(distances(vectors, center[None]).max())
        ids, weights = rows.column("id").to_numpy(), rows.column("weight").to_numpy().astype("<f8")
        return pa.table({
            "label": [key[0]], "block": [f"{key[1].as_py()}/{key[2].as_py()}"], "center": [center.tolist()], "radius": [radius],
            "ids": [ids.astype("<i8").tobytes()], "weights": [weights.tobytes()], "vectors": [own.astype(stored).tobytes()],
        })

    schema = f"label string, block string, center array<double>, radius double, ids binary, weights binary, vectors binary"
    blocks, folder = _written(dealt.groupBy("label", "pivot", "part").applyInArrow(block, schema), "blocks", BLOCKS_PER_FILE)
    collect_garbage(spark)

    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    narrow = lambda c: blocks.select("label", F.col("block").alias(c), F.col("center").alias(f"center_{c}"), F.col("radius").alias(f"radius_{c}"), file.alias(f"file_{c}"))
    # Blocks, not rows, meet here; those out of reach of each other go at once.
    inner = F.aggregate(F.zip_with("center_a", "center_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * inner))
    reach = math.sqrt(2 - 2 * cosine) + 10 * SLACK
    left, right = narrow("a"), narrow("b")
    units = left.join(right, (left["label"] == right["label"]) & (F.col("a") <= F.col("b")) & (apart <= F.col("radius_a") + F.col("radius_b") + reach))
    units = units.select(left["label"], "a", "b", "file_a", "file_b")
    # Few rows with much work each: one task takes a few, of the same blocks where it can.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    units = units.repartitionByRange(4 * tasks, "label", "a", "b").sortWithinPartitions("label", "a", "b")

    def compare(batches):
        trees: dict = {}

        def side(row: dict, c: str) -> tuple:
            name = (row["label"], row[c])
            found = trees.pop(name, None) or read_block(folder, row[f"file_{c}"], *name, stored)
            while len(trees) > 3 and sum(t[1].nbytes for t in trees.values()) > TREE_BYTES:
                trees.pop(next(iter(trees)))
            trees[name] = found
            return found

        for batch in batches:
            for row in batch.to_pylist():
                a, b = side(row, "a"), side(row, "b")
                same = row["a"] == row["b"]
                links_a, links_b, joined = dual_traversal(a[2], b[2], a[1], b[1], same, cosine)
                ids, counts = (a[0], links_a) if same else (np.concatenate([a[0], b[0]]), np.concatenate([links_a, links_b]))
                nodes, least = _forest(joined, a[0], b[0])
                used = counts > 0
                # Two kinds of rows: links of an id, or a link that joins two ids.
                n, m = int(used.sum()), len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids[used], nodes])), pa.array(np.concatenate([np.round(counts[used]).astype(np.int64), np.zeros(m, np.int64)])),
                     pa.array(np.concatenate([np.zeros(n, np.int64), least]), mask=np.arange(n + m) < n)], names=["id", "links", "other"])

    found = materialize(units.mapInArrow(compare, "id long, links long, other long"), "vector-links")
    counts = found.filter("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    # An id whose rows differ in their vectors joins the points of all of them.
    point = F.coalesce(F.xxhash64("key", "label"), F.lit(0))
    differ = rows.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min(point).alias("low"), F.max(point).alias("high")).filter("low <> high").select("id")
    repeated = rows.filter(F.col("key").isNotNull()).join(differ, "id", "left_semi")
    repeated = repeated.select(F.col("id").alias("a"), "label", "key").join(points.select("label", "key", F.col("id").alias("b")), ["label", "key"]).select("a", "b")
    joined = materialize(connected_components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")).unionAll(repeated)), "vector-components")
    heads = points.select("label", "key", F.col("id").alias("head")).join(counts.withColumnRenamed("id", "head"), "head", "left")
    out = rows.join(heads, ["label", "key"], "left").withColumn("head", F.coalesce("head", "id"))
    out = out.join(joined.withColumnRenamed("node", "head"), "head", "left")
    component = F.coalesce("component", "head")
    return out.select(
        F.col("id").alias(id_col),
        # A vector is always linked with itself, which is no link.
        F.greatest(F.coalesce(F.col("links") - 1, F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
