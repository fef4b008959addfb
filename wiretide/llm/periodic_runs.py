"""Runs of periodically repeated words, by a dictionary of basic factors.

The dictionary names every factor (stretch of consecutive words) whose length is a power
of two: equal factors have equal names, and a name of length 2k is that of two names of
length k. Let a run have the smallest period q and at least three times that length, and
let k be the power of two with k / 2 < q <= k. Then each factor of length k of the run
occurs next exactly q words later, within twice its length: less would give the run a
smaller period. So per length the next occurrences at one distance form arithmetic
progressions; neighbouring ones are one stretch, which one more factor and the distance
extend to its full length. Every run comes up once, at the length that fits its period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import WORD, Words, blocks_of, column, fresh_name, plainly_named, row_pass, text_table

#: A run has so many words at least, and so many periods.
LEAST_LENGTH, LEAST_PERIODS = 6, 4
#: Characters whose factors are named at once.
BLOCK = 1 << 20


def factor_levels(words: np.ndarray, owner: np.ndarray, ends: np.ndarray, longest: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per power of two k: k, places, and the distance to the next equal factor of the same text (0: none).

    words: a number per word; owner: the text of each place, whose words end before ends[text].
    A text takes part while k / 2 < longest[text], the longest period asked for. Places
    whose factor occurs once cannot start or end a repeat of a longer one and are left out.
    """
    n = len(words)
    places = np.flatnonzero(longest[owner] > 0)
    # Texts do not share names.
    _, first = np.unique(words[places], return_inverse=True)
    key = owner[places] * np.int64(first.max(initial=0) + 1) + first
    k = 1
    while len(places):
        # A stable sort by name keeps places in order, so the next one of a group is the next occurrence.
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        step = np.zeros(len(places), dtype=np.int64)
        step[order[:-1][same]] = (places[order][1:] - places[order][:-1])[same]
        name = np.empty(len(places), dtype=np.int64)
        name[order] = np.concatenate([[0], np.cumsum(~same)])
        yield k, places, step

        repeated = np.zeros(len(places), dtype=bool)
        repeated[order[:-1][same]] = True
        repeated[order[1:][same]] = True
        names = np.full(n, -1, dtype=np.int64)
        names[places[repeated]] = name[repeated]
        live = places[repeated]
        live = live[(live + 2 * k <= ends[owner[live]]) & (longest[owner[live]] > k)]
        live = live[names[live + k] >= 0]
        places, key = live, names[live] * np.int64(n + 1) + names[live + k]
        k *= 2


def find_runs(words: np.ndarray, starts: np.ndarray, least: int = LEAST_LENGTH, periods: int = LEAST_PERIODS) -> tuple[np.ndarray, ...]:
    """text, start, length and period of every run, by text, start and period.

    Text i has words starts[i]:starts[i + 1]; a run's start counts from its text's first word.
    periods: at least 3, from which on the smallest period shows at a single length.
    """
    if periods < 3:
        raise ValueError("a run has three periods at least")
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = []
    for k, places, step in factor_levels(words, owner, starts[1:], np.where(sizes >= least, sizes // periods, 0)):
        near = np.flatnonzero((2 * step > k) & (step <= k))
        if not len(near):
            continue
        at, period = places[near], step[near]
        # Progressions side by side with one distance are one stretch.
        head = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (period[1:] != period[:-1])])
        heads = np.flatnonzero(head)
        tails = np.concatenate([heads[1:], [len(at)]]) - 1
        begin, q = at[heads], period[heads]
        length = at[tails] - begin + k + q
        long = length >= np.maximum(least, periods * q)
        found.append(np.stack([owner[begin[long]], begin[long], length[long], q[long]]))
    text, begin, length, q = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    order = np.lexsort((q, begin, text))
    text, begin, length, q = text[order], begin[order], length[order], q[order]
    return text, begin - starts[text], length, q


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay if every run is cut to its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:n]) == 0


def runs_of(texts: list) -> Iterator[tuple[list[bytes] | None, np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: its words if it has a run, and start, length and period of its runs."""
    for begin, end in blocks_of(texts, BLOCK):
        words = Words(texts[begin:end])
        text, start, length, period = find_runs(words.hashes, words.starts)
        bounds = np.searchsorted(text, np.arange(end - begin + 1))
        for i in range(end - begin):
            at = slice(bounds[i], bounds[i + 1])
            own = texts[begin + i].encode("utf-8", "surrogatepass").split() if bounds[i] < bounds[i + 1] else None
            yield own, start[at], length[at], period[at]


def run_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: doc_id, start, length, period, unit (the words of its first period). Texts without a run have none."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc, (words, *runs) in zip(batch.column(0).to_pylist(), runs_of(batch.column(1).to_pylist())):
            out += [(doc, int(s), int(n), int(q), b" ".join(words[s : s + q]).decode("utf-8", "surrogatepass")) for s, n, q in zip(*runs)]
        types = [pa.int64()] * 4 + [pa.string()]
        columns = zip(*out) if out else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=["doc_id", "start", "length", "period", "unit"])

    return row_pass(text_table(docs, id_col, text_col), work, "doc_id long, start long, length long, period long, unit string")


def summarize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, n_words_kept.

    start to exponent_milli are of the longest run (then the first, then of the smallest
    period), null without a run. runs_sha256 is of `start,length,period` lines by start and
    period, collapsed_sha256 of the words that stay, joined by one space. Null, empty and
    wordless texts have no run and nothing to keep. Every row gets its own result,
    repeated ones and those without an id too.
    """
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()]
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words_kept"]
    digest = lambda raw: hashlib.sha256(raw).hexdigest()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, texts = [], batch.column(1).to_pylist()
        for text, (words, start, length, period) in zip(texts, runs_of(texts)):
            if words is None:
                words = (text or "").encode("utf-8", "surrogatepass").split()
                out.append((0, None, None, None, None, digest(b""), digest(b" ".join(words)), len(words)))
                continue
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start.tolist(), length.tolist(), period.tolist()))
            stay = [words[i] for i in np.flatnonzero(kept_words(len(words), start, length, period)).tolist()]
            best = int(np.argmax(length))  # the first of the longest: by start, then period
            s, n, q = int(start[best]), int(length[best]), int(period[best])
            out.append((len(start), s, n, q, 1000 * n // q, digest(lines.encode()), digest(b" ".join(stay)), len(stay)))
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, type=t) for c, t in zip(zip(*out), types)]], names=names)

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words_kept long"
    return row_pass(text_table(docs, id_col, text_col), work, schema)


def collapse(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, in texts with a run every run cut to its first period; other texts stay as they are."""
    at = docs.columns.index(text_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        out = []
        for text, (words, start, length, period) in zip(texts, runs_of(texts)):
            if words is not None:
                stay = np.flatnonzero(kept_words(len(words), start, length, period)).tolist()
                text = b" ".join([words[i] for i in stay]).decode("utf-8", "surrogatepass")
            out.append(text)
        columns = [pa.array(out, type=batch.schema.field(at).type) if i == at else batch.column(i) for i in range(batch.num_columns)]
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    plain = plainly_named(docs)
    return row_pass(plain, work, plain.schema).toDF(*docs.columns)


def with_period(docs: DataFrame, when: Column, start: Callable[[Column], Column], period: Callable[[Column, Column], Column], text_col: str = "text") -> DataFrame:
    """The rows; where `when` holds, the words of the text from `start` on repeat the `period` words that begin there.

    start: of the number of words n, from 0 to n - 1; period: of n and the start, at least 1.
    The words of a changed text are joined by one space; texts without a word stay as they are.
    """
    words, n = fresh_name(docs.columns, "list_of_words"), fresh_name(docs.columns, "n_of_words")
    listed = docs.withColumn(words, F.when(when, F.regexp_extract_all(column(text_col), F.lit(WORD), F.lit(0))))
    listed = listed.withColumn(n, F.when(F.size(words) > 0, F.size(words).cast("long")))
    a = start(F.col(n))
    p = period(F.col(n), a)
    # Whole copies of the unit, cut to what follows the start.
    copies = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((F.col(n) - a) / p).cast("int")))
    changed = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(copies, F.lit(1), (F.col(n) - a).cast("int")))
    return listed.withColumn(text_col, F.when(F.col(n).isNotNull(), F.array_join(changed, " ")).otherwise(column(text_col))).drop(words, n)
