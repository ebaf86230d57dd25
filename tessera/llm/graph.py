"""Joins that a hot key cannot overload, beside the library's connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph import components

__all__ = ["attach", "components"]

#: At most so many keys are joined by broadcast.
HEAVY_KEYS = 1000


def attach(rows: DataFrame, table: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """rows left join table on key, where ``size`` says how many rows have the key.

    Keys of at least n_rows / HEAVY_KEYS rows, so HEAVY_KEYS at most, are joined by broadcast; the rest are shuffled.
    """
    least = max(1000, n_rows // HEAVY_KEYS)
    heavy, rest = table.where(F.col(size) >= least), table.where(F.col(size) < least)
    light = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(rest, key, "left")
    return rows.join(F.broadcast(heavy), key).unionByName(light.select(*rows.columns, *(c for c in table.columns if c != key)))
