"""Handing the micro-batches of a stream to user code."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wiretide.sources.package import ship_package

log = logging.getLogger(__name__)

Handler = Callable[[DataFrame, int], None]


def isolated(handler: Handler) -> Handler:
    """A handler whose errors are logged and do not stop the stream."""

    def call(df: DataFrame, batch_id: int) -> None:
        try:
            handler(df, batch_id)
        except Exception:
            log.exception("handler failed on batch %d", batch_id)

    return call


def write_under_batch(path: str) -> Handler:
    """A handler that writes each micro-batch as Parquet under its number, replacing an earlier try."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


#: Records handed to a callback between two batches of results.
RECORDS = 1_000


def each_record(callback: Callable[[dict], dict | None], path: str, schema: T.StructType | str | None = None) -> Handler:
    """A handler that calls back with every single record, in the tasks that hold them.

    An error in a call concerns its record alone: the record goes to the dead letters, as JSON
    with the error, and the next one is taken. What the calls return is kept as rows of the
    schema; calls that return nothing are only counted. ``delivered`` and ``dead_letters``
    read both back. Both are written under the number of the micro-batch, in one pass, so a
    repeated micro-batch replaces them; the callback itself is then called again. It is sent
    to the tasks, so its module must be known there.
    """
    result = T._parse_datatype_string(schema) if isinstance(schema, str) else schema or T.StructType()
    names = result.fieldNames()
    nothing = T.StructType([T.StructField("_called", T.BooleanType())])
    fields = result if names else nothing
    written = T.StructType([*fields, T.StructField("_record", T.StringType()), T.StructField("_error", T.StringType()), T.StructField("_failed", T.BooleanType())])

    def call(df: DataFrame, batch_id: int) -> None:
        ship_package(df.sparkSession)
        # JSON is made by Spark, so a record that fails can be written whatever its types are.
        records = df.select(F.struct("*").alias("r"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
        records.mapInArrow(lambda batches: _called(batches, callback, written, names), written).write.mode("overwrite").partitionBy("_failed").parquet(
            f"{path}/batch={batch_id}"
        )

    return call


def _called(batches: Iterator[pa.RecordBatch], callback: Callable, written: T.StructType, names: list[str]) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(written)
    for batch in batches:
        for at in range(0, batch.num_rows, RECORDS):
            part, out = batch.slice(at, RECORDS), []
            for record, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                try:
                    told = callback(record)
                    row = {n: told[n] for n in names} if names else {"_called": True}
                    # A value that does not fit its column is an error of this record too.
                    pa.RecordBatch.from_pylist([row], schema=pa.schema([schema.field(n) for n in row]))
                    out.append(row | {"_failed": False})
                except Exception as error:
                    out.append({"_record": text, "_error": f"{type(error).__name__}: {error}", "_failed": True})
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def _delivered(spark, path: str, failed: bool, schema: T.StructType) -> DataFrame:
    """One side of what `each_record` wrote, with the number of the micro-batch."""
    whole = T.StructType([*schema, T.StructField("_failed", T.BooleanType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(path).filter(F.col("_failed") == failed).drop("_failed")


def delivered(spark, path: str, schema: T.StructType | str) -> DataFrame:
    """What the callback returned for the records that it took, and ``batch``."""
    return _delivered(spark, path, False, T._parse_datatype_string(schema) if isinstance(schema, str) else schema)


def dead_letters(spark, path: str) -> DataFrame:
    """``record``, ``error`` and ``batch`` of the records that the callback failed on."""
    stored = T.StructType([T.StructField("_record", T.StringType()), T.StructField("_error", T.StringType())])
    return _delivered(spark, path, True, stored).withColumnsRenamed({"_record": "record", "_error": "error"})


def deliver(stream: DataFrame, handler: Handler, folder: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a stream that calls the handler with every micro-batch and its number.

    Where it stands is kept in the folder, which must be one that all executors reach.
    """
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", f"{folder}/checkpoint")
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
