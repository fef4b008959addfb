"""Language identification by the nearest of several centroids per language.

A text is a bag of hashed character n-grams (1 to 3), as a unit TF-IDF vector. A language
has a few centroids, by spherical k-means over a bounded sample of its labelled texts;
the language of the nearest centroid by cosine wins. A text much farther from it than the
language's own sampled texts, cut to its length, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import filter_pass, row_pass, slices, text_table
from wiretide.sources.storage import materialize

UNKNOWN = "und"
SIZES = (1, 2, 3)
BINS = 1 << 13
CENTROIDS = 4
#: Labelled texts per language from which centroids are built.
SAMPLE = 400
ROUNDS = 8
#: A text is rejected below SLACK of the cosine that LOW of its language's sample stays under at its length.
SLACK, LOW = 0.6, 0.05
#: Cosines from which a language's floor at a length is known; with fewer that of all languages counts.
LEAST = 20
#: Sampled texts are also cut to each power of two of characters up to this one.
PART = 1 << 12
CLASSES = 48
#: Characters hashed at once, so a long text needs no more memory.
CHUNK = 1 << 20


def gram_counts(text: str) -> np.ndarray:
    """Counts of the whole text's n-grams by bin: lower-cased letters, all between them one space."""
    counts = np.zeros(BINS, dtype=np.int64)
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    # Beyond ASCII all but Latin-1 signs count as letters; telling scripts apart needs no more.
    letter = ((points >= 97) & (points <= 122)) | ((points >= 0xC0) & (points != 0xD7) & (points != 0xF7))
    points = np.where(letter, points, np.uint64(32))
    points = points[np.concatenate([[True], letter[1:] | letter[:-1]])]
    over = max(SIZES) - 1
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK + over]
        for n in SIZES:
            # The overlap is counted by the chunk it begins in.
            last = min(len(part) - n + 1, CHUNK)
            if last <= 0:
                continue
            key = np.full(last, n, dtype=np.uint64)
            for i in range(n):
                key = key * np.uint64(0x100000001B3) + part[i : i + last]
            counts += np.bincount((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13), minlength=BINS)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=-1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows, dtype=np.float64), where=norm > 0)


def _length_class(counts: np.ndarray) -> int:
    """Powers of two in the number of characters whose n-grams were counted."""
    return min(max(int(counts.sum()) // len(SIZES) - 1, 1).bit_length() - 1, CLASSES - 1)


def _part(text: str) -> str:
    """At most PART characters around the middle, from the start of a word if there is one."""
    at = max(len(text) - PART, 0) // 2
    return text[at if at == 0 else text.find(" ", at, at + 100) + 1 or at :][:PART]


@dataclass(frozen=True)
class LanguageModel:
    """Centroids as rows, the language of each, inverse document frequencies, least cosine by language and length class."""

    languages: tuple[str, ...]
    owners: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected; `und`, 0 and true without a letter."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        counts = gram_counts(text)
        cosines = self.centroids @ self.vector(counts)
        best = int(np.argmax(cosines))
        score = float(min(max(cosines[best], 0.0), 1.0))
        owner = self.owners[best]
        return self.languages[owner], score, bool(score == 0 or score < self.floors[owner, _length_class(counts)])


def _cluster(vectors: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Spherical k-means: farthest-first starts, then ROUNDS of assignment and mean."""
    chosen = [int(seed % len(vectors))]
    nearest = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centers = vectors[chosen].copy()
    for _ in range(ROUNDS):
        owner = np.argmax(vectors @ centers.T, axis=1)
        for i in range(len(centers)):
            if (owner == i).any():
                centers[i] = vectors[owner == i].mean(axis=0)
        centers = _unit(centers)
    return centers


def _sums(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the sum of its texts' vectors, and how many they are.

    Where a language has LEAST texts, one text alone, be it mislabelled or no language, is no centroid.
    """
    owner = np.argmax(vectors @ centers.T, axis=1)
    sizes = np.bincount(owner, minlength=len(centers))
    keep = np.flatnonzero(sizes > (1 if len(vectors) >= LEAST else 0))
    return np.stack([vectors[owner == i].sum(axis=0) for i in keep]), sizes[keep]


def _floors(cosines: dict[str, dict[int, np.ndarray]], languages: tuple[str, ...]) -> np.ndarray:
    """Per language and length class the least cosine; a class with too few texts takes the nearest shorter one, else longer one."""

    def lows(by_class: dict[int, np.ndarray], least: int) -> np.ndarray:
        known = sorted(c for c, x in by_class.items() if len(x) >= least)
        if not known:
            return np.full(CLASSES, np.nan)
        nearest = [max([k for k in known if k <= c], default=known[0]) for c in range(CLASSES)]
        return SLACK * np.array([np.quantile(by_class[k], LOW) for k in nearest])

    together = {c: np.concatenate([x[c] for x in cosines.values() if c in x]) for c in range(CLASSES) if any(c in x for x in cosines.values())}
    pooled = lows(together, LEAST)
    if np.isnan(pooled).any():
        pooled = np.nan_to_num(lows(together, 1))
    own = [lows(cosines.get(lang, {}), LEAST) for lang in languages]
    return np.array([np.where(np.isnan(x), pooled, x) for x in own]).reshape(len(languages), CLASSES)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from rows with a language. Document frequencies count every text; centroids take SAMPLE per language.

    The sample is drawn by a hash of the id. Null or letterless texts teach nothing; with
    no usable row every text is `und`. Floors come from cosines of the sampled texts, whole
    and cut to shorter ones, to centroids without the text itself; languages of one text
    each therefore reject only what shares no n-gram with them.
    """
    rows = text_table(labelled.filter(F.col(lang_col).isNotNull()), id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for name, n in sorted(sizes.items()):
        share = F.when(F.col("lang") == name, min(1.0, 1.5 * SAMPLE / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("language"), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.select("text", "lang", (draw < share).alias("picked"), draw.alias("draw"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts, picked = np.zeros(BINS, dtype=np.int64), 0, []
        for batch in slices(batches):
            for text, lang, take, draw in zip(*[c.to_pylist() for c in batch.columns]):
                if not text or not has_letter(text):
                    continue
                counts = gram_counts(text)
                used = np.flatnonzero(counts)
                seen[used] += 1
                texts += 1
                if take:
                    picked.append((lang, draw, len(text), used.tolist(), counts[used].tolist(), _part(text)))
        for at in range(0, len(picked), 64):
            yield _picked(picked[at : at + 64])
        yield _picked([(None, 0.0, texts, np.flatnonzero(seen).tolist(), seen[seen > 0].tolist(), None)])

    # Per task one row of frequencies, merged bin by bin, and the sampled texts' counts.
    counted = rows.mapInArrow(count, _PICKED)
    counted = materialize(counted, "language-counts")
    totals = counted.filter(F.col("lang").isNull())
    texts = totals.agg(F.coalesce(F.sum("chars"), F.lit(0))).first()[0]
    pairs = totals.select(F.explode(F.arrays_zip("bins", "counts")).alias("p")).groupBy("p.bins").agg(F.sum("p.counts").alias("df"))
    seen = np.zeros(BINS)
    for r in pairs.collect():
        seen[r["bins"]] = r["df"]
    idf = np.log((1.0 + texts) / (1.0 + seen)) + 1.0
    sample = counted.filter(F.col("lang").isNotNull()).drop("part").collect()
    by_lang: dict[str, list] = {}
    for r in sorted(sample, key=lambda r: (r["lang"], r["draw"])):
        by_lang.setdefault(r["lang"], []).append(r)
    languages = tuple(sorted(by_lang))
    owners, centers = [], []
    # Per language: sums of vectors by centroid, texts by centroid, the last draw that was taken.
    held: dict[str, tuple[np.ndarray, np.ndarray, float]] = {}
    for i, lang in enumerate(languages):
        chosen = by_lang[lang][:SAMPLE]
        vectors = np.zeros((len(chosen), BINS))
        for j, r in enumerate(chosen):
            vectors[j, r["bins"]] = np.log1p(r["counts"])
        vectors = _unit(vectors * idf)
        sums, members = _sums(vectors, _cluster(vectors, CENTROIDS, i))
        owners += [i] * len(sums)
        centers.append(_unit(sums))
        held[lang] = (sums, members, chosen[-1]["draw"])
    shared = labelled.sparkSession.sparkContext.broadcast((held, idf))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, idf = shared.value
        for batch in slices(batches, 64):
            found = []
            for r in batch.to_pylist():
                sums, members, last = held[r["lang"]]
                counts = np.zeros(BINS, dtype=np.int64)
                counts[r["bins"]] = r["counts"]
                whole = _unit(np.log1p(counts) * idf)
                others = _unit(sums)
                if r["draw"] <= last:
                    own = int(np.argmax(others @ whole))
                    others[own] = _unit(sums[own] - whole) if members[own] > 1 else 0.0
                found.append((r["lang"], _length_class(counts), float((others @ whole).max())))
                cuts = [r["part"][: 1 << c] for c in range(len(r["part"]).bit_length())]
                for counts in (gram_counts(t) for t in cuts if has_letter(t)):
                    found.append((r["lang"], _length_class(counts), float((others @ _unit(np.log1p(counts) * idf)).max())))
            columns = [pa.array(c, type=t) for c, t in zip(zip(*found), (pa.string(), pa.int32(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "class", "cosine"])

    measured = counted.filter(F.col("lang").isNotNull()).mapInArrow(measure, "lang string, class int, cosine double").toPandas()
    cosines: dict[str, dict[int, np.ndarray]] = {}
    for (lang, length), x in measured.groupby(["lang", "class"])["cosine"]:
        cosines.setdefault(lang, {})[int(length)] = x.to_numpy()
    centroids = np.concatenate(centers) if centers else np.zeros((0, BINS))
    return LanguageModel(languages, np.array(owners, dtype=int), centroids, idf, _floors(cosines, languages))


_PICKED = "lang string, draw double, chars long, bins array<int>, counts array<long>, part string"


def _picked(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.float64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string()]
    names = ["lang", "draw", "chars", "bins", "counts", "part"]
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Per row: doc_id, lang_pred, score, rejected, and the columns of `more` as longs."""
    table = text_table(docs, id_col, text_col, *[c.cast("long").alias(n) for n, c in more.items()])
    shared, names = docs.sparkSession.sparkContext.broadcast(model), list(more)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
        out = [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.string(), pa.float64(), pa.bool_()))]
        return pa.RecordBatch.from_arrays([batch.column(0), *out, *batch.columns[2:]], names=["doc_id", "lang_pred", "score", "rejected", *names])

    return row_pass(table, work, "doc_id long, lang_pred string, score double, rejected boolean" + "".join(f", {n} long" for n in names))


def keep_known(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows the model does not reject, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filter_pass(docs, text_col, lambda texts: np.array([not shared.value.predict(t)[2] for t in texts]))
