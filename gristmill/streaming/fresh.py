"""The freshness gate and idempotent sinks as Structured Streaming."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.functions.dates import freshness
from gristmill.operators.dedup import insert_if_absent


def table_stream(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """A parquet table of a data folder as a stream, whether it is one file or a folder of parts.

    A stream's path must be a folder or a pattern; this pattern matches the table's own name only.
    """
    return spark.readStream.schema(schema).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def fresh_stream(stream: DataFrame, moment: str, reference: datetime, window_hours: float = 24, skew_seconds: float = 60) -> DataFrame:
    """Rows within the window around the run's own reference time. (A watermark follows the data, so it can only bound state.)"""
    return stream.filter(freshness(F.col(moment), reference, window_hours, skew_seconds) == "fresh")


def first_seen_stream(stream: DataFrame, keys: list[str], moment: str, delay: str) -> DataFrame:
    """The first row of each key; state is dropped once the watermark has passed."""
    return stream.withWatermark(moment, delay).dropDuplicatesWithinWatermark(keys)


def append_once(path: str, keys: list[str], order: list[str | Column]):
    """A foreachBatch function: appends rows whose keys the table lacks, so that a repeated batch adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.schema(batch.schema).parquet(path)
        insert_if_absent(batch, stored, keys, order).write.mode("append").parquet(path)

    return write


def run_available(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Runs a stream over all that is there now, then reads the table it wrote."""
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(path)
    query = stream.writeStream.foreachBatch(append_once(path, keys, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
