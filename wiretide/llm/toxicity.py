"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; any texts, labels unseen, are the unlabelled. A
linear model over words and word beginnings minimises the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with logistic loss, so its output is a probability. Where the second part falls below
zero, the step goes the other way for it alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import U64, Words, blocks_of, row_pass, text_table
from wiretide.sources.storage import materialize

#: Bytes of word beginnings that count as features, besides whole words.
PREFIXES = (4, 5, 6, 7, 8)
#: The model is fitted on at most so many confirmed and unlabelled texts, the first by hash of the id.
POSITIVES, UNLABELLED = 2_000, 6_000
#: Features: the FEATURES that set the positives apart most, by a z statistic above LEAST_APART. They are in
#: at least a tenth of the positives or in LEAST_TEXTS of them, whichever is fewer.
LEAST_TEXTS, FEATURES, LEAST_APART = 4, 1_500, 4.0
STEPS, RATE, DECAY = 400, 0.05, 1e-4
BLOCK = 1 << 20
ENTRY = np.dtype([("place", "<u2"), ("amount", "<f4")])


def _features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of the texts as (text number, hash), repeats included, and the words of each text."""
    words = Words(texts, lower=True, prefixes=PREFIXES)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.starts))
    numbers, hashes = [owner], [words.hashes]
    for found in words.prefixes:
        used = found != 0
        numbers.append(owner[used])
        hashes.append(found[used])
    return np.concatenate(numbers), np.concatenate(hashes), np.diff(words.starts)


class Lookup:
    """Places of hashes in a sorted vocabulary; a bitmap sorts most others out first."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.bitmap = np.zeros(1 << 20, dtype=bool)
        self.bitmap[(vocabulary >> U64(44)).astype(np.int64)] = True

    def find(self, numbers: np.ndarray, hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each (text number, place) once, and log(1 + how often it occurs in 100 words)."""
        likely = self.bitmap[(hashes >> U64(44)).astype(np.int64)]
        numbers, hashes = numbers[likely], hashes[likely]
        if not len(hashes) or not len(self.vocabulary):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = self.vocabulary[place] == hashes
        both, times = np.unique(numbers[hit] * np.int64(len(self.vocabulary)) + place[hit], return_counts=True)
        numbers, place = both // len(self.vocabulary), both % len(self.vocabulary)
        return numbers, place, np.log1p(100.0 * times / words[numbers])


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list) -> np.ndarray:
        """Probability of each whole text to be toxic; null counts as empty."""
        out = np.zeros(len(texts))
        lookup = Lookup(self.vocabulary)
        for begin, end in blocks_of(texts, BLOCK):
            numbers, places, amounts = lookup.find(*_features(texts[begin:end]))
            out[begin:end] = np.bincount(numbers, weights=self.weights[places] * amounts, minlength=end - begin)
        return 1.0 / (1.0 + np.exp(-np.clip(out + self.bias, -500, 500)))


def fit_risk(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk estimator, with Adam over all rows."""
    # Once in double precision, not again in every product.
    positive, unlabelled = np.asarray(positive, dtype=np.float64), np.asarray(unlabelled, dtype=np.float64)
    n = positive.shape[1] + 1
    theta, mean, square = np.zeros(n), np.zeros(n), np.zeros(n)
    theta[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    grad = lambda rows, out: np.append(rows.T @ out, out.sum()) / max(len(out), 1)
    for step in range(1, steps + 1):
        zp, zu = positive @ theta[:-1] + theta[-1], unlabelled @ theta[:-1] + theta[-1]
        # Logistic loss: d/dz of log(1 + e^-z) is sigmoid(z) - 1, of log(1 + e^z) sigmoid(z).
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        negative = grad(unlabelled, sigmoid(zu)) - prior * grad(positive, sigmoid(zp))
        g = -negative if negative_risk < 0 else prior * grad(positive, sigmoid(zp) - 1) + negative
        g[:-1] += DECAY * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learns from `labels` (ids confirmed toxic or not) and `docs`, of which only texts are seen.

    The class prior is the share of toxic rows among all labelled ones. With few positives,
    one even, words of a single one are features; texts that share none of them then get the
    prior's score or less. Without a positive, or without a text of one, every text scores 0.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y is not null")
    total, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("y") == 1).cast("long")), F.lit(0))).first()
    nothing = ToxicityModel(np.zeros(0, dtype=U64), np.zeros(0), -500.0)
    if not toxic:
        return nothing
    prior = min(toxic / total, 0.9)
    draw = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    # At most POSITIVES ids, so the broadcast is bounded.
    chosen = known.filter("y = 1").select("doc_id").distinct().orderBy(draw, "doc_id").limit(POSITIVES)
    table = text_table(docs, id_col, text_col)
    share = min(1.0, UNLABELLED / max(docs.count(), 1))
    unlabelled = table.filter(F.pmod(draw, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("text", F.lit(0).alias("positive"))
    positive = table.join(F.broadcast(chosen), "doc_id").select("text", F.lit(1).alias("positive"))
    sample = materialize(positive.unionAll(unlabelled), "toxicity-sample")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in blocks_of(texts, BLOCK):
                numbers, hashes, _ = _features(texts[begin:end])
                order = np.lexsort((hashes, numbers))
                numbers, hashes = numbers[order], hashes[order]
                once = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (numbers[1:] != numbers[:-1])]) if len(hashes) else np.zeros(0, dtype=bool)
                values, counts = np.unique(hashes[once], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], names=["hash", "n"])

    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_positive, n_unlabelled = sizes.get(1, 0), sizes.get(0, 0)
    if not n_positive:
        return nothing
    of = lambda y: sample.filter(F.col("positive") == y).select("text").mapInArrow(counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias(f"n{y}"))
    usual = of(1).filter(F.col("n1") >= min(LEAST_TEXTS, -(-n_positive // 10)))
    # A two-sample z statistic; only features commoner among the positives.
    rates = usual.join(of(0), "hash", "left").select("hash", ((F.col("n1") + 0.5) / (n_positive + 1)).alias("r1"), ((F.coalesce("n0", F.lit(0)) + 0.5) / (n_unlabelled + 1)).alias("r0"))
    pooled = (F.col("r1") * n_positive + F.col("r0") * n_unlabelled) / (n_positive + n_unlabelled)
    spread = F.sqrt(pooled * (1 - F.least(pooled, F.lit(0.999))) * (1 / n_positive + 1 / max(n_unlabelled, 1)))
    apart = rates.select("hash", ((F.col("r1") - F.col("r0")) / spread).alias("apart")).filter(F.col("apart") > LEAST_APART)
    candidates = apart.orderBy(F.desc("apart"), "hash").limit(FEATURES).select("hash").toPandas()["hash"]
    vocabulary = np.sort(candidates.to_numpy(dtype=np.int64).view(U64))
    if not len(vocabulary):
        return nothing

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(0).to_pylist()
        lookup, found = Lookup(vocabulary), []
        for begin, end in blocks_of(texts, BLOCK):
            numbers, at, amounts = lookup.find(*_features(texts[begin:end]))
            entries = np.rec.fromarrays([at, amounts], dtype=ENTRY)
            found += np.split(entries, np.searchsorted(numbers, np.arange(1, end - begin)))
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array([x.tobytes() for x in found], type=pa.binary())], names=["positive", "places"])

    rows = row_pass(sample, places, "positive int, places binary").collect()
    matrices = []
    for y in (1, 0):
        side = [np.frombuffer(r["places"], dtype=ENTRY) for r in rows if r["positive"] == y]
        matrix = np.zeros((len(side), len(vocabulary)), dtype=np.float32)
        for i, entries in enumerate(side):
            matrix[i, entries["place"]] = entries["amount"]
        matrices.append(matrix)
    weights, bias = fit_risk(*matrices, prior)
    return ToxicityModel(vocabulary, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Per row: doc_id, score, predicted, and the columns of `more` as longs."""
    table = text_table(docs, id_col, text_col, *[c.cast("long").alias(n) for n, c in more.items()])
    shared, names = docs.sparkSession.sparkContext.broadcast(model), list(more)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores(batch.column(1).to_pylist())
        columns = [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), *batch.columns[2:]]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted", *names])

    return row_pass(table, work, "doc_id long, score double, predicted int" + "".join(f", {n} long" for n in names))
