"""Where pages, outputs and tables come from."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def worklist(table: DataFrame, where, order: str = "id", limit: int | None = None) -> DataFrame:
    rows = table.where(where).orderBy(order)
    return rows.limit(limit) if limit else rows


def binary_issues(spark: SparkSession, folder: str, pattern: str = "*.pdf", limit: int | None = None) -> DataFrame:
    """Files by path: filename, content.  limit caps files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "content")
    return rows.orderBy("path").limit(limit) if limit else rows


def page_texts(issues: DataFrame, extract: Callable[[bytes], list[str | None]]) -> DataFrame:
    """filename, page (from 1), text of each page, by a pluggable extractor; a null text is empty."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            out = [(f, k, t or "") for f, c in zip(rows["filename"], rows["content"], strict=True) for k, t in enumerate(extract(bytes(c)), 1)]
            yield pd.DataFrame(out, columns=["filename", "page", "text"])

    return issues.select("filename", "content").mapInPandas(run, "filename string, page int, text string")


def encoded_images(images: DataFrame, shrink: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Images as base64, shrunk first by a pluggable function."""
    if shrink:

        @F.pandas_udf("binary")
        def smaller(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for content in parts:
                yield content.map(lambda c: shrink(bytes(c)))

        images = images.withColumn("content", smaller("content"))
    return images.withColumn("data", F.base64("content")).drop("content")


def cached_outputs(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all JSON arrays of a folder, with the file they are from, numbered in order of file and place."""
    rows = spark.read.schema(schema).option("multiLine", True).json(folder).select("*", F.col("_metadata.file_name").alias("source_file"))
    return rows.withColumn("pos", F.monotonically_increasing_id())


def jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A database table, read in parallel by ranges of a numeric column where one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if column and bounds:
        reader = reader.option("partitionColumn", column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()
