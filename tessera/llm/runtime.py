"""What the operators share: the folder that all executors see, written intermediate tables, exact running totals."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.storage import discard, shared_dir, written

__all__ = ["HASHED_BITS", "discard", "hashed_bits", "marked", "running_totals", "shared_dir", "slices", "text_of", "trim", "written"]

#: Bits of a filter on hashed keys.
HASHED_BITS = 1 << 26


def hashed_bits(keys: DataFrame, bits: int = HASHED_BITS) -> np.ndarray:
    """keys: bit.  A bitmap of hashed keys: a fixed size whatever their number, and no key is missed."""
    words = keys.select(F.floor(F.col("bit") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(bit, 64) as int))").alias("value")).groupBy("word").agg(F.bit_or("value").alias("value"))
    out = np.zeros(bits // 64, np.int64)
    for r in words.toLocalIterator():
        out[r["word"]] = r["value"]
    return out.view(np.uint8)


def marked(bit: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the keys' bits are set."""
    return (bits[bit >> 3] >> (bit & 7)) & 1 == 1


#: Rows of an Arrow batch that are handled at once where each brings a whole text.
TEXTS = 1000


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXTS) -> Iterator[pa.RecordBatch]:
    """The batches cut small, so that what is made of them is small too; after each batch, memory that is no longer used goes back to the machine, since a worker lives on for other stages."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        trim()


def trim() -> None:
    pa.default_memory_pool().release_unused()
    if _malloc_trim:
        _malloc_trim(0)


try:
    _malloc_trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not with this C library
    _malloc_trim = None


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


#: Rows that one fine bucket of running_totals holds on average, and fine buckets of a coarse one.
FINE_ROWS, COARSE = 2_000, 1024


def running_totals(df: DataFrame, parts: list[str], order: str, tie: list[str], value: str, out: str, rows: int) -> DataFrame:
    """Adds ``out``: the exact sum of ``value`` over the rows before, within ``parts``, by ``order`` (a uniform 64-bit hash), then ``tie``.

    No window covers a whole part: hashes fall in fine buckets of about FINE_ROWS rows, fine buckets
    in coarse ones, and each level's totals are summed apart.  ``rows`` is the table's row count, or more.
    """
    bits = max(0, (max(1, rows) // FINE_ROWS).bit_length())
    fine = F.shiftright(F.col(order), 64 - bits) if bits else F.lit(0).cast("long")
    df = df.withColumn("_fine", fine)
    keys = [*parts, "_fine"]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum")).withColumn("_coarse", F.floor(F.col("_fine") / COARSE))
    coarse = sums.groupBy(*parts, "_coarse").agg(F.sum("_sum").alias("_all"))
    before = lambda c, names, by: F.coalesce(F.sum(c).over(Window.partitionBy(*names).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = coarse.withColumn("_before_coarse", before("_all", parts, "_coarse")).drop("_all")
    sums = sums.join(coarse, [*parts, "_coarse"]).withColumn("_before", before("_sum", [*parts, "_coarse"], "_fine") + F.col("_before_coarse"))
    sums = sums.select(*keys, "_before")
    inside = Window.partitionBy(*keys).orderBy(order, *tie).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_within", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(sums, keys).withColumn(out, F.col("_within") + F.col("_before")).drop("_within", "_before", "_fine")
