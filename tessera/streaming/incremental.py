"""Incremental forms of the batch operators: extensions, in Spark's own streaming terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def files(spark: SparkSession, folder: str, schema: str, each: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", each).parquet(folder)


def sweep(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Runs a batch function on every micro-batch; it must be idempotent by batch id."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def first_mentions(stream: DataFrame, at: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Mentions without repeats that come within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def mention_counts(stream: DataFrame, at: str, key: str, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.window(at, window), key).agg(F.count("*").alias("n"))


def watch_hits(stream: DataFrame, watches: DataFrame, column: str) -> DataFrame:
    """Standing watches: rows of the stream whose column holds a watch's term."""
    return stream.join(watches, F.lower(F.col(column)).contains(F.lower("term")))
