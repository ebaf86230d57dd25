"""Entity tables in one folder: each version in a folder of its own, the last whole one being the table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sources import sinks, tables


class Store:
    """Reads and writes the tables of a folder that Spark can see."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self, name: str) -> list[int]:
        """The whole versions of a table, in order."""
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/v*/_SUCCESS")
        found = where.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(where)
        return sorted(int(s.getPath().getParent().getName()[1:]) for s in found or [])

    def read(self, name: str) -> DataFrame:
        """The last version; a table that was never written is empty."""
        held = self.versions(name)
        return self.spark.read.schema(tables.schema(name)).parquet(f"{self.folder}/{name}/v{held[-1]:06d}") if held else tables.empty(self.spark, name)

    def all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in tables.SCHEMAS}

    def write(self, name: str, df: DataFrame) -> str:
        return sinks.write_version(tables.conform(df, name), f"{self.folder}/{name}", (self.versions(name) or [0])[-1] + 1)
