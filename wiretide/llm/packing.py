"""Hierarchical packing into windows of several lengths.

A document longer than the longest window gives full windows; its rest, like any shorter
document, goes to the smallest tier that holds it. From the longest tier down, a window
opens with a piece of its tier, its gap takes the longest pieces of shorter tiers that
fit, and what then is left open takes a cut of the next piece. Each task packs what it
reads; the pieces left when its last window stays open are packed again together, so
padding is one window for each few million left-over tokens.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import slices, text_table
from wiretide.llm.tokens import encoder
from wiretide.sources.storage import materialize

TIERS = (512, 1024, 2048, 4096)
#: Tokens a task holds before it packs them.
HELD = 2_000_000
#: Left-over tokens packed by one task of the second round.
SHARED = 2_000_000
#: Windows of the longest tier in a step group.
STEP_WINDOWS = 8

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long, rest binary, number long"


class Piece:
    """A run of one document's ids that is not placed yet."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def __len__(self) -> int:
        return len(self.ids)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.total), Piece(self.doc, self.start + n, self.ids[n:], self.total)


class Shelf:
    """Pieces by length; the longest that fits comes first."""

    def __init__(self, pieces: list[Piece]):
        self.pieces: dict[int, list[Piece]] = {}
        for p in pieces:
            self.pieces.setdefault(len(p), []).append(p)
        self.lengths = sorted(self.pieces)

    def put(self, piece: Piece) -> None:
        at = self.pieces.setdefault(len(piece), [])
        if not at:
            insort(self.lengths, len(piece))
        at.append(piece)

    def take(self, most: int) -> Piece | None:
        """The longest piece of at most `most` ids."""
        i = bisect_right(self.lengths, most)
        if not i:
            return None
        length = self.lengths[i - 1]
        at = self.pieces[length]
        piece = at.pop()
        if not at:
            del self.lengths[i - 1], self.pieces[length]
        return piece


def pack(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full windows as (tier, pieces), and the pieces of the one window that stays open."""
    longest = tiers[-1]
    windows, rests = [], []
    for p in pieces:
        while len(p) >= longest:
            head, p = p.cut(longest)
            windows.append((longest, [head]))
        if len(p):
            rests.append(p)
    shelf = Shelf(rests)
    while shelf.lengths:
        first = shelf.take(shelf.lengths[-1])
        tier = next(t for t in tiers if len(first) <= t)
        window, gap = [first], tier - len(first)
        while gap:
            piece = shelf.take(gap)
            if piece is None:
                if not shelf.lengths:
                    return windows, window
                head, tail = shelf.take(shelf.lengths[0]).cut(gap)
                shelf.put(tail)
                piece = head
            window.append(piece)
            gap -= len(piece)
        windows.append((tier, window))
    return windows, []


def _step_groups(windows: list[tuple[int, list[Piece]]], tiers: tuple[int, ...]) -> list[int]:
    """A step per window: every step gets as near as can be the same tokens, and like attention cost.

    Windows go to steps by falling cost (the sum of squared piece lengths), each to the
    step with the fewest tokens so far, then the least cost.
    """
    import heapq

    tokens = sum(t for t, _ in windows)
    steps = [(0, 0.0, i) for i in range(max(1, round(tokens / (tiers[-1] * STEP_WINDOWS))))]
    out = [0] * len(windows)
    cost = [float(sum(len(p) ** 2 for p in w)) for _, w in windows]
    for i in sorted(range(len(windows)), key=lambda i: (-windows[i][0], -cost[i])):
        filled, spent, step = steps[0]
        heapq.heapreplace(steps, (filled + windows[i][0], spent + cost[i], step))
        out[i] = step
    return out


class _Rows:
    """Rows of the result, gathered by column."""

    def __init__(self, task: int, tiers: tuple[int, ...]):
        self.task, self.tiers = task << 40, tiers
        self.sequence = self.steps = self.number = 0

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.binary(), pa.int64()]
        names = [c.split()[0] for c in PIECE.split(", ")]
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

    def windows(self, windows: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
        rows = []
        steps = _step_groups(windows, self.tiers)
        for (tier, window), step in zip(windows, steps):
            offset = 0
            for p in window:
                crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                rows.append((p.doc, p.start, len(p), crc, p.total, self.task + self.sequence, offset, tier, self.task + self.steps + step, None, None))
                offset += len(p)
            self.sequence += 1
        self.steps += max(steps, default=-1) + 1
        return self._batch(rows)

    def rests(self, pieces: list[Piece]) -> pa.RecordBatch:
        rows = []
        for p in pieces:
            rows.append((p.doc, p.start, len(p), None, p.total, None, None, None, None, p.ids.astype("<u4").tobytes(), self.task + self.number))
            self.number += 1
        return self._batch(rows)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    drops_space: bool = True,
    tiers: tuple[int, ...] = TIERS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A null or empty text is its end id alone. Ids may be null or repeated: every row is a
    document of its own. Texts are tokenized once, where they are read; only the pieces
    left over by the tasks are shuffled.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_space)
        rows = _Rows(TaskContext.get().partitionId(), tiers)
        held, tokens = [], 0
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode.ids(text, end_id)
                held.append(Piece(doc, 0, ids, len(ids)))
                tokens += len(ids)
                if tokens >= HELD:
                    windows, held = pack(held, tiers)
                    tokens = sum(map(len, held))
                    yield rows.windows(windows)
        windows, held = pack(held, tiers)
        yield rows.windows(windows)
        yield rows.rests(held)

    def second(key: tuple, table: pa.Table) -> pa.Table:
        rows = _Rows((1 << 22) + key[0].as_py(), tiers)
        table = table.sort_by("number")
        columns = [table.column(c).to_pylist() for c in ("doc_id", "start", "rest", "doc_tokens")]
        windows, left = pack([Piece(d, s, np.frombuffer(r, dtype="<u4"), n) for d, s, r, n in zip(*columns)], tiers)
        # The one window that stays open is padded to the longest length.
        batches = [rows.windows(windows + ([(tiers[-1], left)] if left else []))]
        return pa.Table.from_batches(batches).select(out)

    placed = materialize(text_table(docs, id_col, text_col).mapInArrow(first, PIECE), "packed")
    out = [c.split()[0] for c in PIECE.split(", ")][:9]
    rests = placed.filter(F.col("sequence_id").isNull())
    tokens = rests.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    groups = max(1, -(-tokens // SHARED))
    again = rests.groupBy(F.pmod(F.xxhash64("number"), F.lit(groups)).alias("share")).applyInArrow(second, ", ".join(PIECE.split(", ")[:9]))
    return placed.filter(F.col("sequence_id").isNotNull()).select(*out).unionByName(again)
