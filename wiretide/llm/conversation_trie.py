"""Prefix trie of conversations that are rebuilt from a base's head and their own later turns.

A sequence of turns has a fingerprint: the sum of its turns' hashes, the i-th times the i-th
power of an odd base, in two lanes modulo 2^64. Fingerprints form a monoid (a sequence
after another is shifted by the other's length), and odd numbers have inverses, so the
fingerprint of every rebuilt prefix follows from prefix fingerprints of the stored turns:
that of the base's head, plus the shifted difference of two own ones. No rebuilt text is
ever made: a rebuilt turn is a row of numbers that refers to a stored turn by its hash.

Equal fingerprints are one node. That is verified: all members of a node must have the
same parent fingerprint, hence the same hash of the last turn, and stored turns with one
hash must have the same role and text.

Sums over subtrees need no walk: a node is counted by the smallest conversation through
it, which also counts all deeper nodes of its own for which it is the smallest. So a sum
over a subtree is one over the node's members, of what each counts from that depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretide.llm.common import U64
from wiretide.sources.storage import materialize

#: Odd bases of the two lanes (fixed).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
#: Turns of a conversation summed in one window; ids in one piece of text to be hashed.
BLOCK_TURNS, PIECE_IDS = 4_096, 65_536

_KEY = ["depth", "p1", "p2"]


def powers(lane: int, exponents: np.ndarray) -> np.ndarray:
    """The lane's base to the exponents, negative ones too, modulo 2^64."""
    out = np.ones(len(exponents), dtype=U64)
    for base, sign in ((BASES[lane], 1), (_INVERSES[lane], -1)):
        left = np.maximum(exponents * sign, 0)
        square = base
        while left.any():
            out = np.where(left & 1, out * U64(square), out)
            square = square * square % (1 << 64)
            left = left >> 1
    return out


def _lanes(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    return [batch.column(f"{name}{i}").to_numpy().view(U64) for i in (1, 2)]


def _table(names: list[str], columns: list) -> pa.RecordBatch:
    signed = [c.view(np.int64) if isinstance(c, np.ndarray) and c.dtype == U64 else c for c in columns]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in signed], names=names)


def _local_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and prefix fingerprints of the turns of each conversation, as if it began in this slice.

    Rows come by conversation and turn. first: the slice's first conversation.
    """
    part = TaskContext.get().partitionId()
    opening = current = None
    count, sums = 0, [U64(0), U64(0)]
    for batch in batches:
        conv = batch.column("conv").to_numpy()
        if not len(conv):
            continue
        opening = conv[0] if opening is None else opening
        begins = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(conv))))
        goes_on = current == conv[0]
        before = np.zeros(len(begins), dtype=np.int64)
        before[0] = count if goes_on else 0
        position = np.arange(len(conv)) - begins[group] + 1 + before[group]
        prefixes = []
        for lane, t in enumerate(_lanes(batch, "t")):
            total = np.cumsum(t * powers(lane, position), dtype=U64)
            earlier = np.concatenate([np.zeros(1, dtype=U64), total])[begins]
            if goes_on:
                earlier[0] -= sums[lane]
            prefixes.append(total - earlier[group])
        current, count, sums = conv[-1], int(position[-1]), [p[-1] for p in prefixes]
        yield _table(
            ["slice", "first", "conv", "position", "p1", "p2", "t1", "t2", "chars"],
            [np.full(len(conv), part, dtype=np.int32), conv == opening, conv, position, *prefixes, *_lanes(batch, "t"), batch.column("chars")],
        )


def _carried(slices: list) -> dict[int, tuple]:
    """Per slice that goes on with an earlier slice's conversation: it, its turns so far, their fingerprints."""
    out, conv, count, sums = {}, None, 0, (0, 0)
    for s in slices:
        head, tail = s["head"], s["tail"]
        n, p = head["position"], [head["p1"] % (1 << 64), head["p2"] % (1 << 64)]
        if head["conv"] == conv:
            out[s["slice"]] = (conv, count, *sums)
            p = [(a + pow(b, count, 1 << 64) * c) % (1 << 64) for a, b, c in zip(sums, BASES, p)]
            n += count
        if tail["conv"] != head["conv"]:
            n, p = tail["position"], [tail["p1"] % (1 << 64), tail["p2"] % (1 << 64)]
        conv, count, sums = tail["conv"], n, tuple(p)
    return out


def prefix_fingerprints(turns: DataFrame) -> DataFrame:
    """conv, position (from 1), p1, p2 (of the turns up to it), t1, t2 (of the turn), chars.

    turns: conv, turn, t1, t2, chars. Conversations are cut into slices of rows in order, so
    that a long one is many; one row per slice goes through the driver.
    """
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows that are equal in all else are told apart by where they lie, so that they can be cut too.
    order = ["conv", "turn", "t1", "t2", "place"]
    dealt = turns.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = "slice int, first boolean, conv long, position long, p1 long, p2 long, t1 long, t2 long, chars long"
    local = materialize(dealt.mapInArrow(_local_prefixes, schema), "turns")
    row = F.struct("conv", "position", "p1", "p2")
    edges = local.groupBy("slice").agg(F.max_by(F.when(F.col("first"), row), F.when(F.col("first"), F.col("position"))).alias("head"), F.max_by(row, F.struct("conv", "position")).alias("tail"))
    carried = _carried(sorted(edges.collect(), key=lambda s: s["slice"]))

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, position = (batch.column(c).to_numpy() for c in ("slice", "conv", "position"))
            position, prefixes = position.copy(), [p.copy() for p in _lanes(batch, "p")]
            for s in np.unique(part).tolist():
                if s in carried:
                    of, count, *sums = carried[s]
                    rows = np.flatnonzero((part == s) & (conv == of))
                    position[rows] += count
                    for lane, p in enumerate(prefixes):
                        p[rows] = p[rows] * U64(pow(BASES[lane], count, 1 << 64)) + U64(sums[lane])
            yield _table(["conv", "position", "p1", "p2", "t1", "t2", "chars"], [conv, position, *prefixes, *_lanes(batch, "t"), batch.column("chars")])

    return materialize(local.mapInArrow(shift, "conv long, position long, p1 long, p2 long, t1 long, t2 long, chars long"), "numbered")


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of rebuilt prefixes: the head's, plus the shifted difference of own ones; and their parents'."""
    for batch in batches:
        depth, shift = batch.column("depth").to_numpy(), batch.column("shift").to_numpy()
        prefixes, parents = [], []
        for lane, (own, skipped, head, t) in enumerate(zip(*(_lanes(batch, c) for c in ("own", "skipped", "head", "t")))):
            prefixes.append(head + powers(lane, shift) * (own - skipped))
            parents.append(prefixes[-1] - t * powers(lane, depth))
        yield _table(["conv", "depth", "p1", "p2", "q1", "q2", "chars", "turns"], [batch.column("conv"), depth, *prefixes, *parents, batch.column("chars"), batch.column("turns")])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 per node of its pieces, which come in order."""
    current, digest, done = None, None, []
    for batch in batches:
        for *key, _, piece in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "low", "piece"))):
            if key != current:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(piece.encode())
            else:
                digest.update(f",{piece}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*_KEY, "ends_sha256"])
            done = []
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*current, digest.hexdigest())], names=[*_KEY, "ends_sha256"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node, comma-joined."""
    for batch in batches:
        depth, p1, p2, conv = (batch.column(c).to_numpy() for c in (*_KEY, "conv"))
        if not len(conv):
            continue
        begins = np.flatnonzero(np.concatenate([[True], (depth[1:] != depth[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])]))
        begins = np.unique(np.concatenate([begins, np.arange(0, len(conv), PIECE_IDS)]))
        text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(begins, np.append(begins[1:], len(conv)))]
        yield _table([*_KEY, "low", "piece"], [depth[begins], p1[begins], p2[begins], conv[begins], pa.array(text, type=pa.string())])


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of the ids that end there, ascending, comma-joined; a hot node's ids are joined in many tasks."""
    order = [*_KEY, "conv"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces, "depth long, p1 long, p2 long, low long, piece string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "low").mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")


def verify_turns(turns: DataFrame, numbered: DataFrame) -> None:
    """Raises where stored turns of one hash differ in role or text.

    Only hashes of several turns are looked at; equal turns are merged before the shuffle.
    """
    repeated = materialize(numbered.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("t1", "t2"), "repeated")
    texts = turns.join(repeated, ["t1", "t2"], "left_semi").groupBy("t1", "t2", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    if texts.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").head(1):
        raise ValueError("different turns have one hash")


def prefix_trie(
    turns: DataFrame,
    base: Callable[[Column], Column],
    head: Callable[[Column], Column],
    most_head: int,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt from the first head(c) turns (0 to most_head) of base(c), all
    if it has fewer and none if it is absent, and its own turns after its first head(c). Turns
    go by number, null first; those of one number by a hash of role and text. Null roles
    and texts are empty; rows without a conversation belong to none. Repeated rows are
    turns of their own. Without conversations there is no node, not even the root.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    stored = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")
    )
    stored = stored.select("*", *[F.xxhash64(F.lit(i), "role", "text").alias(f"t{i}") for i in (1, 2)])
    numbered = prefix_fingerprints(stored.select("conv", "turn", "t1", "t2", F.char_length("text").cast("long").alias("chars")))
    verify_turns(stored, numbered)

    # One row per conversation, with the few turns at its start that may be a head.
    early = F.when(F.col("position") <= most_head, F.struct("position", "p1", "p2", "t1", "t2", "chars"))
    convs = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(early)).alias("early"))
    convs = materialize(convs.select("*", head(F.col("conv")).cast("int").alias("h"), base(F.col("conv")).alias("base")), "conversations")
    heads = convs.select(F.col("conv").alias("base"), F.col("early").alias("of_base"))
    taken = F.least("h", F.coalesce(F.size("of_base"), F.lit(0)))
    plans = convs.join(heads, "base", "left").withColumn("taken", taken)
    at = lambda array, n, field: F.when(F.col(n) > 0, F.get(F.col(array), F.col(n) - 1)[field]).otherwise(F.lit(0))
    plans = plans.select(
        "conv", "n", "h", "taken", F.slice(F.coalesce("of_base", F.array().cast("array<struct<position:bigint,p1:bigint,p2:bigint,t1:bigint,t2:bigint,chars:bigint>>")), F.lit(1), F.col("taken")).alias("of_base"),
        *[at("of_base", "taken", f"p{i}").alias(f"head{i}") for i in (1, 2)], *[at("early", "h", f"p{i}").alias(f"skipped{i}") for i in (1, 2)],
        (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("long").alias("turns"),
    )
    plans = materialize(plans, "plans")

    zero = F.lit(0).cast("long")
    from_head = plans.select("conv", "turns", F.explode("of_base").alias("e")).select(
        "conv", F.col("e.position").alias("depth"), zero.alias("shift"), *[F.col(f"e.p{i}").alias(f"own{i}") for i in (1, 2)],
        *[zero.alias(f"{c}{i}") for c in ("skipped", "head") for i in (1, 2)], "e.t1", "e.t2", "e.chars", "turns",
    )
    own = numbered.filter(F.col("position") > head(F.col("conv"))).join(plans.filter("n > h").drop("n", "of_base"), "conv")
    shift = (F.col("taken") - F.col("h")).cast("long")
    from_own = own.select(
        "conv", (F.col("position") + shift).alias("depth"), shift.alias("shift"), *[F.col(f"p{i}").alias(f"own{i}") for i in (1, 2)],
        "skipped1", "skipped2", "head1", "head2", "t1", "t2", "chars", "turns",
    )
    rebuilt = from_head.unionAll(from_own).mapInArrow(_composed, "conv long, depth long, p1 long, p2 long, q1 long, q2 long, chars long, turns long")
    rebuilt = materialize(rebuilt, "rebuilt")

    nodes = rebuilt.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.min("chars").alias("chars"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        ((F.min("q1") == F.max("q1")) & (F.min("q2") == F.max("q2")) & (F.min("chars") == F.max("chars"))).alias("alike"),
    )
    checked = F.when(F.col("alike"), F.col("n_convs")).otherwise(F.raise_error(F.lit("different prefixes have one fingerprint")).cast("long"))
    nodes = materialize(nodes.withColumn("n_convs", checked).drop("alike"), "nodes")
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(kids, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = materialize(nodes, "nodes-and-children")

    # What a conversation counts from each depth on; long ones block by block.
    counts = nodes.select(
        F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf")
    )
    rows = rebuilt.select("conv", *_KEY, "turns", F.floor(F.col("depth") / BLOCK_TURNS).alias("block")).join(counts, ["conv", "depth"], "left")
    below = Window.partitionBy("conv", "block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), zero)
    blocks = rows.filter(F.col("turns") >= BLOCK_TURNS).groupBy("conv", "block").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    blocks = blocks.select("conv", "block", *[total(c, later).alias(f"later_{c}") for c in ("saved", "leaf")])
    rows = rows.select("conv", *_KEY, "block", *[total(c, below).alias(c) for c in ("saved", "leaf")]).join(blocks, ["conv", "block"], "left")
    sums = rows.groupBy(*_KEY).agg(*[F.sum(F.col(c) + F.coalesce(f"later_{c}", zero)).alias(c) for c in ("saved", "leaf")])
    sums = materialize(sums, "subtrees")

    ends = rebuilt.filter("depth = turns").select("conv", *_KEY)
    turnless = plans.filter("turns = 0").select("conv", *[zero.alias(c) for c in _KEY])
    ends = materialize(end_digests(ends.unionAll(turnless)), "ends")
    top = plans.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    first = sums.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("leaf"), zero).alias("leaf"), F.coalesce(F.sum("saved"), zero).alias("saved"))
    root = top.join(first, F.lit(True)).select(
        "conv_id", *[zero.alias(c) for c in _KEY], F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", F.greatest("leaf", F.lit(1)).alias("leaf"), "saved"
    )
    parents = nodes.filter("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    parents = parents.unionAll(top.select(F.lit(1).cast("long"), zero, zero, "conv_id"))
    found = nodes.join(sums, _KEY).join(parents, ["depth", "q1", "q2"])
    found = found.select("conv_id", *_KEY, "parent_conv_id", "n_convs", "n_children", "leaf", "saved").unionAll(root)
    return found.join(ends, _KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaf").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
