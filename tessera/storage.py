"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a session on a cluster raises, since
    a machine-local folder would not be seen by the other machines.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame) -> DataFrame:
    """The same rows, written as Parquet in the shared folder and read back: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def discard(df: DataFrame) -> None:
    """Removes a table that ``written`` gave, once nothing that is still to run reads it."""
    if path := _PATHS.pop(df, None):
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    """Removes a folder; a session that is already gone leaves it to the cluster's own clean-up."""
    context = spark.sparkContext
    if context._jsc is None or context._gateway is None:
        return
    try:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the gateway can close first
        return
