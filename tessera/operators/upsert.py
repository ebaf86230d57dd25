"""Keyed writes as set operations: each returns the table's next version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.storage import written


def some_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def first_by_key(rows: DataFrame, keys: list[str], order: list[str], nulls_distinct: bool = False) -> DataFrame:
    """One row a key, the first by the columns of ``order``, ascending, nulls last.

    nulls_distinct: rows with a null key are never the same, as in a unique index; they are kept without
    a shuffle.  Where the order is all that rows have beside their key, its least value is aggregated;
    else the rows are ranked, and Spark ranks within each task before it shuffles.
    """
    keyed = rows.where(~some_null(keys)) if nulls_distinct else rows
    if set(rows.columns) == set(keys):
        one = keyed.distinct()
    elif len(order) == 1 and set(rows.columns) == {*keys, *order}:
        one = keyed.groupBy(*keys).agg(F.min(order[0]).alias(order[0])).select(*rows.columns)
    else:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.asc_nulls_last(c) for c in order)))
        one = keyed.withColumn("_k", rank).where("_k = 1").drop("_k")
    return one.unionByName(rows.where(some_null(keys))) if nulls_distinct else one


def _same(a: DataFrame, b: DataFrame, keys: list[str], null_safe: bool):
    on = None
    for k in keys:
        one = a[k].eqNullSafe(b[k]) if null_safe else a[k] == b[k]
        on = one if on is None else on & one
    return on


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: list[str], order: list[str], nulls_distinct: bool = True) -> DataFrame:
    """The table and those rows, one a key, whose key it lacks."""
    fresh = first_by_key(rows, keys, order, nulls_distinct)
    known = table.select(*keys).distinct()
    return table.unionByName(fresh.join(known, _same(fresh, known, keys, not nulls_distinct), "left_anti"), allowMissingColumns=True)


def upsert_sightings(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sightings by key: the earliest first_seen, the latest last_seen, the greatest confidence.  Rows without a key are skipped."""
    ok = rows.where(" and ".join(f"{k} is not null and cast({k} as string) <> ''" for k in keys))
    both = table.select(*keys, "first_seen", "last_seen", "confidence").unionByName(ok.select(*keys, "first_seen", "last_seen", "confidence"))
    return both.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.max("confidence").alias("confidence"))


def upsert_flag(table: DataFrame, rows: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Keys of both, with the flag true for keys among the rows."""
    set_ = rows.select(*keys).distinct().withColumn("_new", F.lit(True))
    return table.join(set_, keys, "full").withColumn(flag, F.coalesce("_new", flag)).drop("_new")


def fill_nulls(table: DataFrame, changes: DataFrame, key: str, keep: list[str] = (), replace: list[str] = ()) -> DataFrame:
    """Columns of ``keep`` are filled where null; those of ``replace`` take the new value where there is one."""
    new = changes.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in [*keep, *replace]))
    out = table.join(new, key, "left")
    for c in keep:
        out = out.withColumn(c, F.coalesce(c, f"_{c}"))
    for c in replace:
        out = out.withColumn(c, F.coalesce(f"_{c}", c))
    return out.select(*table.columns)


def replace_scope(table: DataFrame, rows: DataFrame, scope: list[str]) -> DataFrame:
    """Rows of the table outside of the scopes that the new rows have, and the new rows."""
    return table.join(rows.select(*scope).distinct(), scope, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete_keys(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return table.join(ids.select(key).distinct(), key, "left_anti")


def with_ids(rows: DataFrame, order: list, start: int = 0, id_col: str = "id") -> DataFrame:
    """Consecutive ids after ``start`` in the order given.

    The rows are dealt by range, sorted within each task and written once with their place; the written
    places are then counted and offset, so that counts and rows are of one and the same dealing, and no
    task sees all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = written(ranged)  # the upper bits are the task, the lower 33 the place in it
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a task
    offsets = counts.select("_part", before.alias("_before"))
    out = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.withColumn(id_col, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + start + 1).drop("_part", "_at", "_before")
