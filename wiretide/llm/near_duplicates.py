"""Near-duplicate documents by MinHash bands, odd sketches and a check on full sets.

Texts with equal shingle sets are one class. Representatives meet in buckets of banded
MinHash values. The values are also folded into a parity bitmap (odd sketch); the bits in
which two bitmaps differ tell the similarity of near texts well, so most false candidates
end there. Links are confirmed on the whole sets.

Buckets are not expanded into all pairs: every member is first compared with the bucket's
center, the member that shares most buckets with most others (for edited copies, their
original). The members that have the same center in most company are a cluster: those it
does not link are compared with the rest of it block by block, and a block gives out no
more links than it has members. After that only pairs that are in different clusters and
not yet in one component meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import U64, Words, blocks_of, column, fresh_name, mix64, pair_hash, row_pass, text_table
from wiretide.llm.components import connected_components
from wiretide.sources.storage import materialize

#: Shingles of SHINGLE words; links from PERCENT of the union on.
SHINGLE, PERCENT = 5, 80
#: At 0.8 one of 48 bands of 6 agrees but for 5 in 10 million pairs.
BANDS, ROWS = 48, 6
SKETCH_BITS = 512
BLOCK = 1 << 20
#: Members of a cluster compared at once, and shingles of them at once.
BLOCK_ROWS, COLUMNS = 400, 8_192

_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=U64))
_FACTORS = (_SEEDS[: BANDS * ROWS].astype(np.uint32) | np.uint32(1))[:, None]
_SHIFTS = _SEEDS[BANDS * ROWS :].astype(np.uint32)[:, None]
_LANES = np.arange(BANDS * ROWS, dtype=U64) << U64(32)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-word shingles; fewer words are one shingle, no words none."""
    if not len(words):
        return words
    last = max(len(words) - n, 0) + 1
    size = min(n, len(words))
    hashes = words[:last] ^ U64(size)
    for i in range(1, size):
        hashes = pair_hash(hashes, words[i : i + last])
    return np.unique(hashes if size > 1 else mix64(hashes))


def shingle_sets(texts: list, n: int) -> list[np.ndarray]:
    """The set of each whole text, A-Z lower-cased."""
    out = []
    for begin, end in blocks_of(texts, BLOCK):
        words = Words(texts[begin:end], lower=True)
        out += [shingle_set(words.of(i), n) for i in range(end - begin)]
    return out


def minhash(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of a non-empty set."""
    keys = (shingles >> U64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(keys), 512):
        np.minimum(least, (keys[at : at + 512] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = least.reshape(BANDS, ROWS).astype(U64)
    key = np.arange(1, BANDS + 1, dtype=U64)
    for i in range(ROWS):
        key = pair_hash(key, rows[:, i])
    return key


def odd_sketch(least: np.ndarray) -> np.ndarray:
    """The minima's parity bitmap as 64-bit words."""
    at = mix64(_LANES | least.astype(U64)) % U64(SKETCH_BITS)
    bits = (np.bincount(at.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view("<i8")


def most_bits(similarity: float, deviations: float = 5.5) -> int:
    """Differing sketch bits up to which a pair may have the similarity, `deviations` above the mean."""
    samples, bits = BANDS * ROWS, SKETCH_BITS
    apart = 2 * samples * (1 - similarity)
    mean = bits / 2 * (1 - math.exp(-2 * apart / bits))
    of_samples = math.exp(-2 * apart / bits) * 2 * math.sqrt(samples * similarity * (1 - similarity))
    of_folding = math.sqrt(bits / 4 * (1 - math.exp(-4 * apart / bits)))
    return math.ceil(mean + deviations * math.hypot(of_samples, of_folding))


_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def signatures(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_key (two checksums of the set), bands, sketch words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, left, right, bands, sketches = [], [], [], [], []
        none = np.zeros(0, dtype=np.int64)
        for s in shingle_sets(batch.column(1).to_pylist(), shingle):
            sizes.append(len(s))
            left.append(int(mix64(s).sum(dtype=U64).view(np.int64)))
            right.append(int(mix64(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).view(np.int64)))
            least = minhash(s) if len(s) else None
            bands.append(none if least is None else band_keys(least).view(np.int64))
            sketches.append(np.zeros(len(_SKETCH), dtype=np.int64) if least is None else odd_sketch(least))
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(left, pa.int64()), pa.array(right, pa.int64())]
        columns.append(pa.array(bands, type=pa.list_(pa.int64())))
        columns += [pa.array(np.ascontiguousarray(c)) for c in np.stack(sketches).T]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "left", "right", "bands", *_SKETCH])

    schema = "doc_id long, n_shingles long, left long, right long, bands array<long>, " + ", ".join(f"{c} long" for c in _SKETCH)
    return row_pass(text_table(docs, id_col, text_col), work, schema)


def _near(percent: int) -> Column:
    """Whether sizes and sketches of rows a and b allow a link."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    apart = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in _SKETCH), F.lit(0))
    return (small * 100 >= large * percent) & (apart <= most_bits(percent / 100))


def _compared(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b and other long columns) with linked: whether their full sets link."""
    names = pairs.columns

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, second = (batch.column(c).to_pylist() for c in ("text_a", "text_b"))
        keep = np.zeros(batch.num_rows, dtype=bool)
        for begin in range(0, batch.num_rows, 64):
            end = min(begin + 64, batch.num_rows)
            # Neighbouring rows often share their first text.
            once: dict = {}
            for t in first[begin:end] + second[begin:end]:
                once.setdefault(t, len(once))
            sets = shingle_sets(list(once), shingle)
            for i in range(begin, end):
                x, y = sets[once[first[i]]], sets[once[second[i]]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                keep[i] = union > 0 and 100 * both >= percent * union
        return pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(keep)], names=[*names, "linked"])

    side = lambda c: texts.select(F.col("doc_id").alias(c), F.col("text").alias(f"text_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select(*names, "text_a", "text_b")
    return row_pass(joined, check, ", ".join(f"{c} long" for c in names) + ", linked boolean")


def _linked_blocks(first: list[np.ndarray], second: list[np.ndarray], percent: int) -> np.ndarray:
    """For sets of two sides, which pairs link: shared elements by products of incidence matrices."""
    sizes = [np.array([len(x) for x in side]) for side in (first, second)]
    values, counts = np.unique(np.concatenate([*first, *second]), return_counts=True)
    values = values[counts > 1]
    both = np.zeros((len(first), len(second)), dtype=np.float32)
    for at in range(0, len(values), COLUMNS):
        part = values[at : at + COLUMNS]
        matrices = []
        for side in (first, second):
            matrix = np.zeros((len(side), len(part)), dtype=np.float32)
            for i, x in enumerate(side):
                x = x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], side="right")]
                place = np.minimum(np.searchsorted(part, x), len(part) - 1)
                matrix[i, place[part[place] == x]] = 1
            matrices.append(matrix)
        both += matrices[0] @ matrices[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - both
    return (union > 0) & (100 * both >= percent * union)


def _spanning(linked: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what `linked` joins, one per node: to the smallest id it reaches."""
    rows, columns = first.copy(), second.copy()
    top = np.iinfo(np.int64).max
    while True:
        new_rows = np.minimum(rows, np.where(linked, columns[None, :], top).min(axis=1, initial=top))
        new_columns = np.minimum(columns, np.where(linked, new_rows[:, None], top).min(axis=0, initial=top))
        if (new_rows == rows).all() and (new_columns == columns).all():
            break
        rows, columns = new_rows, new_columns
    nodes, least = np.concatenate([first, second]), np.concatenate([rows, columns])
    return nodes[nodes != least], least[nodes != least]


def _within_clusters(cluster: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of cluster members that the center does not link, to all of their cluster.

    cluster: center, doc_id, linked (to the center), without the centers' own rows. Rows are
    dealt out to pairs of blocks of about BLOCK_ROWS; a block of linked rows meets no other such block.
    """
    blocks = lambda n: F.ceil(n / BLOCK_ROWS).cast("int")
    linked = F.col("linked")
    # A center is one of the linked rows; one row beside it has met it already.
    sizes = cluster.groupBy("center").agg((F.count_if(linked) + 1).alias("n_in"), F.count_if(~linked).alias("n_out")).filter("n_out > 0 and n_in + n_out > 2")
    sizes = materialize(sizes.select("center", blocks(F.col("n_in")).alias("in"), blocks(F.col("n_out")).alias("out")), "cluster-sizes")
    rows = cluster.select("center", "doc_id", "linked").join(sizes, "center")
    rows = rows.unionAll(sizes.select("center", F.col("center").alias("doc_id"), F.lit(True).alias("linked"), "in", "out"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.when(linked, F.col("in")).otherwise(F.col("out"))).cast("int"))
    every = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    met = lambda i, inside, j, side: F.struct(i.alias("i"), F.lit(inside).alias("inside"), j.alias("j"), side.alias("side"))
    block = F.col("block")
    of_linked = F.transform(every("out"), lambda i: met(i, True, block, F.lit(1)))
    of_others = F.concat(
        F.transform(every("in"), lambda j: met(block, True, j, F.lit(0))),
        F.transform(every("out"), lambda k: met(F.least(block, k), False, F.greatest(block, k), F.when(block <= k, 0).otherwise(1))),
    )
    units = rows.select("center", "doc_id", F.explode(F.when(linked, of_linked).otherwise(of_others)).alias("u")).join(texts, "doc_id")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ids, side = table.column("doc_id").to_numpy(), table.column("side").to_numpy()
        sets = shingle_sets(table.column("text").to_pylist(), shingle)
        alone = not key[2].as_py() and key[1].as_py() == key[3].as_py()
        first = np.flatnonzero(side == 0)
        second = first if alone else np.flatnonzero(side == 1)
        if not len(first) or not len(second):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        found = _linked_blocks([sets[i] for i in first], [sets[i] for i in second], percent)
        a, b = _spanning(found, ids[first], ids[second])
        return pa.table({"a": a, "b": b})

    units = units.select("center", F.col("u.i").alias("i"), F.col("u.inside").alias("inside"), F.col("u.j").alias("j"), F.col("u.side").alias("side"), "doc_id", "text")
    return units.groupBy("center", "i", "inside", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    Null, empty and wordless texts have no shingle and link with nothing. Rows with one
    id are one node of the link graph, so an id with several texts joins what is near any of
    them and has one component. Rows without an id link with nothing and are kept,
    without a component.
    """
    signed = materialize(signatures(docs, shingle, id_col, text_col), "signatures")
    usable = signed.filter("doc_id is not null and n_shingles > 0")
    same_set = ["left", "right", "n_shingles"]
    # What a text's set decides is the same in all rows of a class.
    of_set = [F.first(c).alias(c) for c in ("bands", *_SKETCH)]
    classes = usable.groupBy(same_set).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("size"), *of_set)
    classes = materialize(classes, "classes")
    heads = classes.withColumnRenamed("first", "doc_id")
    bands = heads.select("doc_id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("members"))
    met = materialize(bands.join(shared.filter("low < high").select("band", "members"), "band"), "met")
    company = met.groupBy("doc_id").agg(F.sum("members").alias("company"))
    centers = met.join(company, "doc_id").groupBy("band").agg(F.max(F.struct("company", (-F.col("doc_id")).alias("minus"))).alias("m"))
    centers = centers.select("band", (-F.col("m.minus")).alias("center"), "m.company")
    sketch = heads.select("doc_id", "n_shingles", *_SKETCH)
    side = lambda c: sketch.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n_{c}"), *[F.col(s).alias(f"{s}_{c}") for s in _SKETCH])
    ids = met.select("doc_id").distinct()
    texts = text_table(docs, id_col, text_col).join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    texts = materialize(texts, "met-texts")

    # Every member with one of its buckets' centers: of the near ones that in most company.
    stars = met.join(centers, "band").filter("doc_id <> center").select(F.col("center").alias("a"), F.col("doc_id").alias("b"), "company").distinct()
    near = stars.join(side("a"), "a").join(side("b"), "b").filter(_near(percent))
    best = near.groupBy("b").agg(F.max(F.struct("company", (-F.col("a")).alias("minus"))).alias("m")).select((-F.col("m.minus")).alias("a"), "b")
    best = materialize(best, "stars")
    # An id with several texts is linked if one of them is.
    stars = _compared(best, texts, shingle, percent).groupBy("a", "b").agg(F.max("linked").alias("linked"))
    stars = materialize(stars, "star-links")

    # The others of a cluster with all of it. A center has more company than its members (or
    # a smaller id), so no chain of centers leads back: only the link itself joins the two.
    members = stars.select(F.col("a").alias("center"), F.col("b").alias("doc_id"), "linked")
    inner = _within_clusters(members, texts, shingle, percent)
    # An id whose rows differ in their sets joins the classes of all of them.
    sets = signed.filter("doc_id is not null").groupBy("doc_id").agg(*[F.min(c).alias(f"{c}_low") for c in same_set], *[F.max(c).alias(f"{c}_high") for c in same_set])
    several = sets.filter(" or ".join(f"{c}_low <> {c}_high" for c in same_set)).select("doc_id")
    repeated = usable.join(several, "doc_id", "left_semi").select("doc_id", *same_set).distinct().join(classes, same_set)
    links = stars.filter("linked").select("a", "b").unionAll(inner).unionAll(repeated.select(F.col("doc_id").alias("a"), F.col("first").alias("b")))
    joined = connected_components(links)

    # What is left: pairs of a bucket in different clusters that no link joins so far. A
    # center is compared with its own cluster there, and with others here.
    placed = met.join(joined.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    placed = materialize(placed.select("band", "doc_id", F.coalesce("component", "doc_id").alias("component")), "placed")
    split = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("band")
    cluster = best.select(F.col("b").alias("doc_id"), F.col("a").alias("center"))
    rest = placed.join(split, "band").join(sketch, "doc_id").join(cluster, "doc_id", "left").withColumn("center", F.coalesce("center", "doc_id"))
    rest = materialize(rest, "rest")
    one = lambda c: rest.select("band", F.col("doc_id").alias(c), F.col("component").alias(f"component_{c}"), F.col("center").alias(f"center_{c}"), F.col("n_shingles").alias(f"n_{c}"), *[F.col(s).alias(f"{s}_{c}") for s in _SKETCH])
    left, right = one("a"), one("b")
    pairs = left.join(right, (left["band"] == right["band"]) & (F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b")) & (F.col("center_a") != F.col("center_b")) & _near(percent))
    pairs = pairs.select("a", "b", "component_a", "component_b").distinct()
    more = _compared(pairs, texts, shingle, percent).filter("linked")
    # These links join whole components.
    final = connected_components(more.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))

    of_class = classes.filter("size > 1").select(*same_set, "first")
    rows = signed.select("doc_id", *same_set).join(of_class, same_set, "left")
    rows = rows.withColumn("head", F.when(F.col("n_shingles") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id")))
    rows = rows.join(joined.select(F.col("node").alias("head"), F.col("component").alias("part")), "head", "left").withColumn("part", F.coalesce("part", "head"))
    rows = rows.join(final.select(F.col("node").alias("part"), "component"), "part", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "part"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with all its columns, and all rows without a word.

    Every row is a document of its own here, whatever its id: repeated rows and rows without an
    id are copies like others, and different texts under one id are kept apart. The row with the
    smallest id stays (none counts as the largest), of several with one id the first as stored.
    """
    row, dropped = fresh_name(docs.columns, "row_number"), fresh_name(docs.columns, "dropped")
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, shingle, percent, row, text_col).select(F.col("doc_id").alias(row), "component_id")
    # Groups are few where copies are: only rows of groups of two and more are looked at.
    groups = materialize(found, "groups")
    several = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component_id")
    members = groups.join(several, "component_id").join(numbered.select(row, column(id_col).cast("long").alias("id")), row)
    members = materialize(members.select("component_id", F.struct(F.col("id").isNull().alias("last"), "id", F.col(row).alias("row")).alias("m")), "members")
    stays = members.groupBy("component_id").agg(F.min("m").alias("stays"))
    gone = members.join(stays, "component_id").filter(F.col("m.row") != F.col("stays.row")).select(F.col("m.row").alias(dropped))
    return numbered.join(gone, F.col(row) == F.col(dropped), "left_anti").drop(row)
