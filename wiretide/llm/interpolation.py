"""A bigram language model by deleted interpolation, counted over the whole corpus.

    p(w | v) = l2 c(v w) / c(v) + l1 c(w) / N + l0 / (V + 1)

with weights by how often the context v was seen (classes by powers of two), learned by
expectation-maximisation on held-out counts: every training token is scored by counts
from which it is deleted. For that its two probabilities are rounded to quarter powers of
two, which changes the weights, and a text's score by some hundredths of a per cent.

Texts become chunks of token numbers, each with its own vocabulary. A chunk asks for the
corpus counts of its distinct words and word pairs, in slices by hash; the owner of a
slice adds what all chunks have and answers in the order of the question. Every distinct
key leaves a chunk once, so frequent words are no load, and nothing is kept whole in one
place. With n chunks there are n slices; beyond MOST_SLICES of them, groups of about sqrt(n)
chunks add up first, so that messages number n * sqrt(n) and stay some kilobytes large.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import U64, Words, blocks_of, mix64, pair_hash, slices, text_table
from wiretide.sources.storage import materialize

#: Characters turned into words at once, and gathered in a chunk.
BLOCK, CHUNK = 1 << 20, 8 << 20
CLASSES = 48
#: Probabilities of held-out tokens are counted to a quarter of a power of two.
FINENESS = 4
ROUNDS = 60
#: Slices that every chunk asks; with more, chunks ask by groups.
MOST_SLICES = 4096
END, BEGIN = U64(0x6C62272E07BB0142), U64(0x27D4EB2F165667C5)

CHUNKS = "chunk long, ids array<long>, train array<boolean>, sizes array<int>, vocabulary binary, tokens binary, trained long"


def _pack(values: np.ndarray) -> bytes:
    """Compressed, byte planes apart."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def _pack_sorted(keys: np.ndarray, idle: int = 0) -> bytes:
    """Sorted keys, of which the lowest `idle` bits are 0."""
    return _pack(np.diff(keys, prepend=U64(0)) >> U64(idle))


def _unpack_sorted(data: bytes, idle: int = 0) -> np.ndarray:
    return np.cumsum(_unpack(data, U64) << U64(idle), dtype=U64)


def idle_bits(tokens: int) -> int:
    """Bits of a pair's hash that need not travel: with 20 more than count the tokens, one pair in a million shares its key."""
    return max(0, 64 - 20 - int(max(tokens, 1)).bit_length())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row, as a chunk is large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def chunked(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """The texts as chunks, one row each: per document its words, A-Z lower-cased, and then one end."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = TaskContext.get().partitionId() << 24, 0
        ids, flags, sizes, hashes, held = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            used = np.array(sizes)
            columns = [[first + number], [list(ids)], [list(flags)], [used.tolist()], [_pack_sorted(vocabulary)], [_pack(tokens.astype(np.uint32))]]
            columns.append([int(used[np.array(flags, dtype=bool)].sum())])
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64()]
            names = ["chunk", "ids", "train", "sizes", "vocabulary", "tokens", "trained"]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

        for batch in slices(batches):
            some_ids, texts, some_flags = (c.to_pylist() for c in batch.columns)
            for begin, end in blocks_of(texts, BLOCK):
                words = Words(texts[begin:end], lower=True)
                hashes.append(np.insert(words.hashes, words.starts[1:], END))
                sizes += (np.diff(words.starts) + 1).tolist()
                ids += some_ids[begin:end]
                flags += some_flags[begin:end]
                held += sum(len(t) for t in texts[begin:end] if t)
                if held >= CHUNK:
                    yield close()
                    number, held = number + 1, 0
                    for x in (ids, flags, sizes, hashes):
                        x.clear()
        if ids:
            yield close()

    table = text_table(docs, id_col, text_col, F.coalesce(train, F.lit(False)).alias("train"))
    return table.mapInArrow(rows, CHUNKS)


class Chunk:
    """A chunk's tokens, its word keys and its pair keys, each sorted, with counts in training texts."""

    def __init__(self, row: dict, idle: int):
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.words = _unpack_sorted(row["vocabulary"])
        self.tokens = _unpack(row["tokens"], np.uint32)
        self.learn = np.repeat(np.array(row["train"], dtype=bool), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        # Before a text's first token stands the begin mark, beyond the vocabulary.
        self.before = np.roll(self.tokens, 1)
        self.before[starts] = len(self.words)
        marked = np.append(self.words, BEGIN)
        keys = pair_hash(marked[self.before], self.words[self.tokens]) >> U64(idle) << U64(idle)
        self.pairs, pair = np.unique(keys, return_inverse=True)
        self.pair = pair.astype(np.uint32)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        words = np.bincount(self.tokens[self.learn], minlength=len(self.words))
        pairs = np.bincount(self.pair[self.learn], minlength=len(self.pairs))
        return words.astype(np.uint32), pairs.astype(np.uint32)


def _slices(keys: np.ndarray, bits: int, first: int = 0, width: int = 64) -> np.ndarray:
    """Where each of 2^bits slices of the 2^width numbers from `first` on begins in sorted keys, and the end."""
    edges = U64(first) + (np.arange(1, 1 << bits, dtype=U64) << U64(width - bits))
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _messages(asker: int, slices: np.ndarray, sides: list, cuts: list, idle: int) -> pa.RecordBatch:
    """One row per slice: the asker's keys in it, and what it has counted of each."""
    columns: list = []
    for i, ((keys, counts), at) in enumerate(zip(sides, cuts)):
        columns.append([_pack_sorted(keys[a:b], i * idle) for a, b in zip(at[:-1], at[1:])])
        columns.append([_pack(counts[a:b]) for a, b in zip(at[:-1], at[1:])])
    arrays = [pa.array(np.full(len(slices), asker)), pa.array(slices), *[pa.array(c, type=pa.binary()) for c in columns]]
    return pa.RecordBatch.from_arrays(arrays, names=["asker", "slice", "words", "word_counts", "pairs", "pair_counts"])


MESSAGE = "asker long, slice long, words binary, word_counts binary, pairs binary, pair_counts binary"
ANSWER = "asker long, slice long, words binary, pairs binary, types long"


def _asked(table: pa.Table, side: str, idle: int) -> list[np.ndarray]:
    return [_unpack_sorted(x, idle if side == "pairs" else 0) for x in table.column(side).to_pylist()]


def _summed(table: pa.Table, side: str, idle: int, kind: type) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The messages' keys; distinct keys, their totals, and where each asked key stands among them."""
    asked = _asked(table, side, idle)
    values, where = np.unique(np.concatenate(asked), return_inverse=True)
    told = np.concatenate([_unpack(x, kind) for x in table.column(f"{side[:-1]}_counts").to_pylist()])
    return asked, values, np.bincount(where, weights=told, minlength=len(values)).astype(np.uint64), where


def _answers(asked: DataFrame, idle: int, kind: type) -> DataFrame:
    """Per message: the corpus counts of its keys, in their order; types once per slice."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        out, types = [], 0
        for side in ("words", "pairs"):
            keys, _, total, where = _summed(table, side, idle, kind)
            # Words alone are types; a slice can hold pairs and no word.
            if side == "words":
                types = int((total > 0).sum())
            out.append([_pack(x) for x in np.split(total[where], np.cumsum([len(k) for k in keys])[:-1])])
        first = np.zeros(len(out[0]), dtype=np.int64)
        first[0] = types
        return pa.table({"asker": table.column("asker"), "slice": table.column("slice"), "words": out[0], "pairs": out[1], "types": first})

    return asked.groupBy("slice").applyInArrow(answer, ANSWER)


def _answers_by_groups(asked: DataFrame, bits: int, rest: int, idle: int) -> DataFrame:
    """The same by two hops: a slice of a group of chunks adds up what these have, and asks for them all.

    Slices are numbered (group, leading bits), and each asks 2^rest slices of its stretch of numbers.
    """

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        node = key[0].as_py()
        lead, width = node & 0xFFFFFFFF, 64 - bits
        sides = [_summed(table, side, idle, np.uint32)[1:3] for side in ("words", "pairs")]
        cuts = [_slices(values, rest, lead << width, width) for values, _ in sides]
        return pa.Table.from_batches([_messages(node, (lead << rest) + np.arange(1 << rest), sides, cuts, idle)])

    def spread(key: tuple, messages: pa.Table, answers: pa.Table) -> pa.Table:
        order, out = np.argsort(answers.column("slice").to_numpy()), []
        for side in ("words", "pairs"):
            asked = _asked(messages, side, idle)
            values, counts = np.unique(np.concatenate(asked)), answers.column(side).to_pylist()
            total = np.concatenate([_unpack(counts[i], np.uint64) for i in order])
            out.append([_pack(total[np.searchsorted(values, keys)]) for keys in asked])
        first = np.zeros(messages.num_rows, dtype=np.int64)
        first[0] = sum(answers.column("types").to_pylist())
        return pa.table({"asker": messages.column("asker"), "slice": messages.column("slice"), "words": out[0], "pairs": out[1], "types": first})

    asked = materialize(asked, "asked")
    answers = _answers(asked.groupBy("slice").applyInArrow(merge, MESSAGE), idle, np.uint64)
    return asked.groupBy("slice").cogroup(answers.groupBy("asker")).applyInArrow(spread, ANSWER)


def answered(chunks: DataFrame, bits: int, idle: int, most: int = MOST_SLICES) -> DataFrame:
    """The chunks, each with the corpus counts of its words and pairs: columns answers and, once per slice, types.

    Up to `most` slices a chunk asks all 2^bits of them. Beyond, messages would become many
    and small: a chunk asks half as many bits' worth of slices of its group of chunks.
    """
    lead = bits if 1 << bits <= most else (bits + 1) // 2
    groups = 1 << (bits - lead)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            chunk = Chunk(row, idle)
            sides = list(zip((chunk.words, chunk.pairs), chunk.counts()))
            group = int(mix64(np.array([row["chunk"]], dtype=U64))[0]) % groups
            yield _messages(row["chunk"], (group << 32) + np.arange(1 << lead), sides, [_slices(keys, lead) for keys, _ in sides], idle)

    asked = chunks.select("chunk", "train", "sizes", "vocabulary", "tokens").mapInArrow(ask, MESSAGE)
    answers = _answers(asked, idle, np.uint32) if groups == 1 else _answers_by_groups(asked, lead, bits - lead, idle)
    parts = F.sort_array(F.collect_list(F.struct("slice", "words", "pairs"))).alias("answers")
    return chunks.join(answers.groupBy(F.col("asker").alias("chunk")).agg(parts, F.sum("types").alias("types")), "chunk")


def _class(seen: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 and up by powers of two."""
    return np.where(seen > 0, 1 + np.floor(np.log2(np.maximum(seen, 1))).astype(int), 0).clip(max=CLASSES - 1)


@dataclass(frozen=True)
class Corpus:
    """Training tokens, distinct training tokens, training texts."""

    tokens: int
    types: int
    texts: int


class Counted:
    """A chunk with corpus counts of every token: of itself, its context, and both together."""

    def __init__(self, row: dict, texts: int, idle: int):
        self.chunk = Chunk(row, idle)
        words = np.concatenate([_unpack(a["words"], np.uint64) for a in row["answers"]]).astype(np.int64)
        pairs = np.concatenate([_unpack(a["pairs"], np.uint64) for a in row["answers"]]).astype(np.int64)
        self.word = words[self.chunk.tokens]
        self.context = np.append(words, texts)[self.chunk.before]
        self.both = pairs[self.chunk.pair]


def _ratio(part: np.ndarray, whole: np.ndarray | int) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=np.asarray(whole) > 0)


def held_out(counted: Counted, corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Cells (class, bigram and unigram probability in steps, 0 for none) of the training tokens, each deleted from its counts; and how many."""
    learn = counted.chunk.learn
    word, context, both = counted.word[learn] - 1, counted.context[learn] - 1, counted.both[learn] - 1

    def step(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, 1 + np.round(-FINENESS * np.log2(np.maximum(p, 1e-300))).astype(np.int64), 0).clip(max=999)

    cell = (_class(context) * 1000 + step(_ratio(both, context))) * 1000 + step(_ratio(word, corpus.tokens - 1))
    return np.unique(cell, return_counts=True)


def learn_weights(cells: np.ndarray, counts: np.ndarray, types: int) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per context class, by expectation-maximisation.

    A class no held-out token has takes those of the class below. The uniform weight
    never falls to zero, so that every text has a probability.
    """
    weights = np.tile([0.0, 0.5, 0.5], (CLASSES, 1))
    p = lambda step: np.where(step > 0, 2.0 ** (-(step - 1) / FINENESS), 0.0)
    for c in range(CLASSES):
        own = cells // 1_000_000 == c
        n = counts[own].astype(float)
        if not n.sum():
            weights[c] = weights[c - 1] if c else weights[c]
            continue
        ml = np.stack([p(cells[own] // 1000 % 1000), p(cells[own] % 1000), np.full(own.sum(), 1.0 / (types + 1))], axis=1)
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = ml * w
            share /= share.sum(axis=1, keepdims=True)
            w = (n[:, None] * share).sum(axis=0) / n.sum()
            w = np.maximum(w, [0.0, 0.0, 1e-6])
            w /= w.sum()
        weights[c] = w
    return weights


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_SLICES) -> DataFrame:
    """Per row: doc_id, train, n_tokens, n_known, train_tokens, base_score, score.

    train: which rows the counts come from. A null or empty text is its end alone. Rows
    are documents of their own, whatever their ids; with no training row all counts are 0.
    """
    chunks = materialize(chunked(docs, train, id_col, text_col), "chunks")
    n, tokens = chunks.agg(F.count(F.lit(1)), F.coalesce(F.sum("trained"), F.lit(0))).first()
    texts = chunks.agg(F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))), F.lit(0))).first()[0]
    # A slice for each chunk or so: both sides of the exchange grow alike.
    bits = max(1, int(max(n, 1) - 1).bit_length())
    idle = idle_bits(tokens)
    counted = materialize(answered(chunks, bits, idle, most), "counted")
    corpus = Corpus(tokens, counted.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0], texts)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found, times = held_out(Counted(row, corpus.texts, idle), corpus)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(times.astype(np.int64))], names=["cell", "n"])

    columns = ["train", "sizes", "vocabulary", "tokens", "answers"]
    histogram = counted.select(*columns).mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # At most CLASSES * 1000 * 1000 cells by their definition; in text some thousands.
    found = histogram.orderBy("cell").toPandas()
    weights = learn_weights(found["cell"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.int64), corpus.types)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            counted = Counted(row, corpus.texts, idle)
            sizes = counted.chunk.sizes
            starts = np.cumsum(sizes) - sizes
            own = _class(counted.context)
            p = weights[own, 0] * _ratio(counted.both, counted.context)
            p += weights[own, 1] * _ratio(counted.word, corpus.tokens)
            p += weights[own, 2] / (corpus.types + 1)
            base = np.log10((counted.word + 1) / (corpus.tokens + 1 * (corpus.types + 1)))
            out = [pa.array(row["ids"], pa.int64()), pa.array(row["train"], pa.bool_()), pa.array(sizes)]
            out.append(pa.array(np.add.reduceat((counted.word > 0).astype(np.int64), starts)))
            out.append(pa.array(np.full(len(sizes), corpus.tokens, dtype=np.int64)))
            out += [pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts))]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return counted.select("ids", *columns).mapInArrow(score, schema)
