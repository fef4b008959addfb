"""Packets behind the watermark, set aside and counted.

A watermarked aggregation drops what comes too late without a trace. Here a stream is
parted first: each micro-batch goes into a table of packets in time and one of late ones,
under its number, with the counts of both. What is in time is never dropped later, so the
packets of all flow sessions and the late ones make up the input.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wiretide.operators.packets import split_valid
from wiretide.schemas import MICROS, ExtractionConfig
from wiretide.sources import storage
from wiretide.sources.storage import children, read_text, write_text
from wiretide.streaming.delivery import deliver


def _marks(spark: SparkSession, folder: str) -> dict[int, dict]:
    found = sorted(int(n[:-5]) for n in children(spark, f"{folder}/marks") if n.endswith(".json"))
    return {v: json.loads(read_text(spark, f"{folder}/marks/{v:012d}.json")) for v in found}


def part_late(
    packets: DataFrame, folder: str, delay_seconds: float = 10.0, config: ExtractionConfig = ExtractionConfig(), trigger: dict | None = None
) -> StreamingQuery:
    """Start to part a packet stream into ``in_time`` and ``late`` tables below the folder.

    The watermark of a micro-batch is the latest time of all earlier ones, less the delay. A
    packet is late if a session of it alone would have ended by then. A repeated micro-batch
    is parted by the same watermark and replaces what it wrote. Unusable packets are in neither.
    """
    spark, delay_us = packets.sparkSession, round(delay_seconds * MICROS)

    def take(batch: DataFrame, batch_id: int) -> None:
        earlier = [m["latest_us"] for v, m in _marks(spark, folder).items() if v < batch_id and m["latest_us"] is not None]
        usable = split_valid(batch)[0]
        late = F.lit(False)
        if earlier:
            late = F.col("ts_us") + config.timeout_us <= max(earlier) - delay_us
        # One pass writes both sides, in files of which a reader sorts no more than some millions of rows.
        parted = usable.withColumn("late", late)
        parted.write.mode("overwrite").option("maxRecordsPerFile", storage.FILE_ROWS).partitionBy("late").parquet(f"{folder}/parted/batch={batch_id}")
        told = spark.read.schema(parted.schema).parquet(f"{folder}/parted/batch={batch_id}").agg(
            F.max("ts_us").alias("latest_us"), F.count_if("late").alias("late"), F.count_if(~F.col("late")).alias("in_time")
        )
        mark = told.first().asDict()
        mark["latest_us"] = max([t for t in (*earlier, mark["latest_us"]) if t is not None], default=None)
        write_text(spark, f"{folder}/marks/{batch_id:012d}.json", json.dumps(mark))

    return deliver(packets, take, f"{folder}/parting", trigger)


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Per micro-batch: ``batch``, ``in_time``, ``late``, and the latest time up to it."""
    rows = [(v, m["in_time"], m["late"], m["latest_us"]) for v, m in _marks(spark, folder).items()]
    return spark.createDataFrame(rows, "batch long, in_time long, late long, latest_us long")


def _with_place(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("late", T.BooleanType()), T.StructField("batch", T.LongType())])


def late_packets(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The late packets, and ``batch``."""
    return spark.read.schema(_with_place(schema)).parquet(f"{folder}/parted").filter("late").drop("late")


def in_time_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The packets in time, as a stream of what has been parted when a micro-batch of it begins.

    Its micro-batches are as large as the parting's or larger, so its own watermark is never
    ahead of the one by which a packet was let through.
    """
    whole = spark.readStream.schema(_with_place(schema)).parquet(f"{folder}/parted")
    return whole.filter("NOT late").drop("late", "batch")
