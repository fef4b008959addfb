"""Token-id files: documents compressed one by one with a shared zstandard dictionary.

Layout of a file, integers little-endian:

    8 bytes   magic WTTOKEN1
    32 bytes  sha-256 of the dictionary
    4 bytes   bytes per id (2 or 4)
    frames    one zstandard frame per document, ids as an array
    index     per document: doc_id int64, has_id int64, offset of its frame int64,
              bytes of its frame int64, ids int64
    24 bytes  offset of the index int64, documents int64, magic WTTOKEND

Any document can be read alone: its index row, then its frame. The dictionary lies beside
the files as dictionary.zdict. Files are in ascending document order, by number.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wiretide.llm.common import slices, text_table
from wiretide.llm.tokens import encoder
from wiretide.sources.storage import materialize

HEAD, TAIL = b"WTTOKEN1", b"WTTOKEND"
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "<i8"), ("offset", "<i8"), ("size", "<i8"), ("ids", "<i8")])
#: Documents the dictionary is trained on, the smallest by hash of their id, and the longest text taken.
SAMPLE_DOCS, SAMPLE_CHARS = 1_000, 50_000
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
#: A file is closed at this size, so a reader never holds more.
FILE_BYTES = 32 << 20
#: Documents per task of the writing pass.
TASK_DOCS = 8_000
DICTIONARY = "dictionary.zdict"


def _store(folder: str):
    """The file system of a folder and the path within it; plain paths are local files."""
    from pyarrow import fs

    if not urlsplit(folder).scheme:
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), urlsplit(folder).path
    return fs.FileSystem.from_uri(folder)


def _put(folder: str, name: str, content: bytes) -> None:
    """Writes a file at once: a task that runs again replaces it with the same bytes."""
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    temporary = posixpath.join(path, f".{name}.{uuid.uuid4().hex}")
    with store.open_output_stream(temporary) as out:
        out.write(content)
    store.move(temporary, posixpath.join(path, name))


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary, or no bytes where there is too little to train on."""
    try:
        return zstandard.train_dictionary(size, [s for s in samples if s]).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b""


def _codec(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class FileWriter:
    """Builds one file in memory, up to FILE_BYTES."""

    def __init__(self, dictionary: bytes, width: int):
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **_codec(dictionary))
        self.prefix = HEAD + hashlib.sha256(dictionary).digest() + np.array([width], dtype="<u4").tobytes()
        self.clear()

    def clear(self) -> None:
        self.frames, self.index, self.size, self.total = [], [], len(self.prefix), 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        frame = self.compressor.compress(ids.tobytes())
        self.index.append((doc or 0, doc is not None, self.size, len(frame), len(ids)))
        self.frames.append(frame)
        self.size += len(frame)
        self.total += len(ids)

    def content(self) -> bytes:
        index = np.array(self.index, dtype=INDEX).tobytes()
        tail = np.array([self.size, len(self.index)], dtype="<i8").tobytes() + TAIL
        return b"".join([self.prefix, *self.frames, index, tail])


class FileReader:
    """Reads documents of one file's bytes, each by its index row."""

    def __init__(self, content: bytes, dictionary: bytes):
        if content[:8] != HEAD or content[-8:] != TAIL:
            raise ValueError("not a token file, or a cut one")
        if content[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the file was written with another dictionary")
        width = int(np.frombuffer(content, dtype="<u4", count=1, offset=40)[0])
        self.type = np.dtype(f"<u{width}")
        at, n = np.frombuffer(content, dtype="<i8", count=2, offset=len(content) - 24)
        self.index = np.frombuffer(content, dtype=INDEX, count=int(n), offset=int(at))
        self.content = memoryview(content)
        self.decompressor = zstandard.ZstdDecompressor(**_codec(dictionary))

    def ids(self, i: int) -> np.ndarray:
        row = self.index[i]
        frame = self.content[row["offset"] : row["offset"] + row["size"]]
        return np.frombuffer(self.decompressor.decompress(frame), dtype=self.type)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    drops_space: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Writes all documents below `folder`; returns a table of its files in order.

    Columns: file, part, number, documents, ids. The folder must be one that all
    executors reach. Rows are range-partitioned by (id, hash of the text), null ids
    first; a repeated id falls apart by text, and identical rows by a running number.
    """
    table = text_table(docs, id_col, text_col)
    draw = F.xxhash64(F.lit("dictionary"), F.col("doc_id"))
    short = table.filter(F.length("text") <= SAMPLE_CHARS)
    # Below this draw lie about twice the documents wanted, so tasks send the driver no text that cannot be among them.
    share = 2 * SAMPLE_DOCS / max(docs.count(), 1)
    if share < 1:
        short = short.filter(draw < F.lit(int(share * (1 << 64)) - (1 << 63)))
    picked = [r[0] for r in short.select("text", draw.alias("draw")).orderBy("draw").limit(SAMPLE_DOCS).collect()]
    encode = encoder(tokenizer, drops_space)
    dictionary = train_dictionary([encode.ids(t, end_id).tobytes() for t in picked])
    _put(folder, DICTIONARY, dictionary)
    width = encode.type.itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_space)
        part, number, files = TaskContext.get().partitionId(), 0, []
        out = FileWriter(dictionary, width)

        def close() -> None:
            nonlocal number
            name = f"part-{part:06d}-{number:05d}.tokens"
            _put(folder, name, out.content())
            files.append((name, part, number, len(out.index), out.total))
            number += 1
            out.clear()

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.add(doc, encode.ids(text, end_id))
                if out.size >= FILE_BYTES:
                    close()
        if out.index:
            close()
        if files:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["file", "part", "number", "documents", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*files), types)], names=names)

    rows = docs.count()
    tasks = max(1, -(-rows // TASK_DOCS), min(rows, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    numbered = table.select("doc_id", "text", order[1].alias("h"), order[2].alias("n"))
    ordered = numbered.repartitionByRange(tasks, "doc_id", "h", "n").sortWithinPartitions("doc_id", "h", "n")
    files = ordered.select("doc_id", "text").mapInArrow(write, "file string, part long, number long, documents long, ids long")
    return materialize(files, "token-files")


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Every document of the listed files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    store, path = _store(folder)
    with store.open_input_stream(posixpath.join(path, DICTIONARY)) as source:
        dictionary = source.read()
    before = Window.partitionBy(F.lit(0)).orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                reader = FileReader(content.as_py(), dictionary)
                index, crcs = reader.index, []
                for i in range(len(index)):
                    ids = reader.ids(i)
                    if len(ids) != index["ids"][i]:
                        raise ValueError("a frame does not hold the ids its index row names")
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                docs = pa.array(index["doc_id"].astype(np.int64), mask=index["has_id"] == 0)
                counts = index["ids"].astype(np.int64)
                columns = [pa.array([name] * len(index)), docs, pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, type=pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "doc_id", "within", "n_tokens", "ids_crc32"])

    contents = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    docs = contents.mapInArrow(read, "file string, doc_id long, within long, n_tokens long, ids_crc32 long")
    # Only the files of the table count: what a lost attempt left behind joins with nothing.
    return docs.join(starts, "file").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
