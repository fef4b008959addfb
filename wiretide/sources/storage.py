"""Small file-system helpers that work on any storage Spark can reach."""

from __future__ import annotations

import gc
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


#: Rows of a file whose reader sorts what it reads. Spark counts 4 MB for opening a file and
#: gives a task 128 MB, so a task holds 32 files at most, however large the table is.
FILE_ROWS = 100_000


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, none if it does not exist."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of an earlier one; it appears under its name once it is complete."""
    fs, target = _filesystem(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot write '{path}'")


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = _filesystem(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def reached_by_path(folder: str) -> tuple:
    """The folder as pyarrow reaches it, within a task: file system and path."""
    from pyarrow import fs

    if folder.startswith("file:") or not urlsplit(folder).scheme:
        return fs.LocalFileSystem(), urlsplit(folder).path
    return fs.FileSystem.from_uri(folder)


def collect_garbage(spark: SparkSession) -> None:
    """Frees what finished jobs shuffled; else it stays on disk until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it; none is invented."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir, when the session is built, to a folder that driver and executors share")
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder within the shared one."""
    return f"{shared_folder(spark)}/wiretide/{name}-{uuid.uuid4().hex}"


def use_shared_checkpoints(spark: SparkSession) -> None:
    """Checkpoints of tables that Spark itself writes go to the shared folder, if the session has not said where."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(f"{shared_folder(spark)}/wiretide/checkpoints")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The table, written to the shared folder and read back.

    For a table that is read several times: what is behind it runs once, reads take
    only the columns they need, and a lost executor costs no recomputation.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
