"""What the operators of this folder share: table access, row passes, word hashing, fold numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wiretide.sources.package import ship_package

__all__ = ["ship_package"]

#: Bytes of rows that are handed to Python at once; a row is never cut.
BATCH_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose rows go to Python by bytes and not by ten thousands, whatever the texts' lengths.

    Executors keep the memory of their largest batch, in the JVM and in every Python worker,
    from one stage to the next; this is a setting of the session.
    """

    @wraps(stage)
    def run(spark: SparkSession, *args) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, *args)

    return run


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """The column of that very name, dots and quotes in it included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_table(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator works on, whatever else the table has."""
    return docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"), *more)


def id_crc32(id_column: Column) -> Column:
    """crc32 of the id as text, from 0 to 2^32 - 1; null ids count as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts."""
    return id_crc32(id_column) % parts


def fresh_name(columns: list[str], name: str) -> str:
    """The name, lengthened until no column of the table has it (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_pass(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Batch by batch over the rows, without a shuffle."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield work(part)

    return df.mapInArrow(over, schema)


def filter_pass(df: DataFrame, text_col: str, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """The rows whose texts `keep` accepts, with all their columns, without a shuffle."""

    at = df.columns.index(text_col)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            mask = np.asarray(keep(part.column(at).to_pylist()), dtype=bool)
            yield part.filter(pa.array(mask))

    plain = plainly_named(df)
    return plain.mapInArrow(over, plain.schema).toDF(*df.columns)


def plainly_named(df: DataFrame) -> DataFrame:
    """The table with its columns numbered: Spark's passes over Arrow batches take no names with dots."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def mix64(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the splitmix64 finalizer, fixed constants)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=U64))
_BASE = U64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, dtype=U64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        size = max(n, 1024)
        _POWERS = np.concatenate([np.ones(1, dtype=U64), np.cumprod(np.full(size - 1, _BASE, dtype=U64), dtype=U64)])
    return _POWERS


class Words:
    """Words of many texts at once.

    hashes: one 64-bit hash per word, in order; starts[i]:starts[i + 1] are those of
    text i. chars: code points per word, if asked for. prefixes: for each asked number of
    bytes, hashes of the words' first bytes, 0 where a word has no more than these.
    """

    def __init__(self, texts: list, lower: bool = False, chars: bool = False, prefixes: tuple[int, ...] = ()):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        blob = b"\n".join(raws) + b"\n"
        if lower:
            blob = blob.lower()
        ends = np.cumsum([len(r) + 1 for r in raws]) if raws else np.zeros(0, dtype=np.int64)
        data = np.frombuffer(blob, dtype=np.uint8)
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        before = np.concatenate([[False], inside[:-1]])
        begin = np.flatnonzero(inside & ~before)
        solid = data[inside]
        # Lengths: where the run of non-space bytes ends.
        after = np.concatenate([inside[1:], [False]])
        length = np.flatnonzero(inside & ~after) - begin + 1
        n = len(begin)
        if n:
            first = np.concatenate([[0], np.cumsum(length)[:-1]])
            offset = np.arange(len(solid)) - np.repeat(first, length)
            values = _BYTE[solid] * _powers(int(length.max()))[offset]
            self.hashes = mix64(np.add.reduceat(values, first) + length.astype(U64))
            if prefixes:
                sums = np.concatenate([np.zeros(1, dtype=U64), np.cumsum(values, dtype=U64)])
                self.prefixes = [np.where(length > m, mix64(sums[np.minimum(first + m, len(solid))] - sums[first] + U64(m << 32)), U64(0)) for m in prefixes]
            if chars:
                self.chars = np.add.reduceat(((solid & 0xC0) != 0x80).astype(np.int64), first)
        else:
            self.hashes = np.zeros(0, dtype=U64)
            self.prefixes = [self.hashes for _ in prefixes]
            if chars:
                self.chars = np.zeros(0, dtype=np.int64)
        self.starts = np.concatenate([[0], np.searchsorted(begin, ends)]).astype(np.int64)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.starts[i] : self.starts[i + 1]]


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of each ordered pair."""
    return mix64(left * U64(0xD6E8FEB86659FD93) + (right ^ U64(0xA0761D6478BD642F)))


def blocks_of(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `limit` characters at most; a longer text makes a run alone."""
    begin, total = 0, 0
    for i, t in enumerate(texts):
        size = len(t) if t else 0
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(texts):
        yield begin, len(texts)
