"""Exact nearest neighbours by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors and bytes of a packed block at most; queries scored at once; candidates that a task holds before it passes them on.
BLOCK, BLOCK_BYTES, STEP, HELD = 2048, 1 << 22, 256, 500_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def length(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(length(a) * length(b), F.lit(0.0))


def nearest(rows: DataFrame, query: list[float], k: int, vector: str = "embedding", id_col: str = "id") -> DataFrame:
    """The k rows nearest to one query: a top-k, with no sort of the table."""
    q = F.array(*(F.lit(float(x)) for x in query))
    return rows.withColumn("similarity", cosine(F.col(vector), q)).orderBy(F.desc_nulls_last("similarity"), id_col).limit(k)


def _packed(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """ids, width, data: blocks of up to BLOCK unit vectors of one width as bytes; a vector of length 0, null or with a null in it becomes NaN."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, starts = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
            for width in np.unique(sizes):
                of, step = np.flatnonzero(sizes == width), max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, width))))
                for k in range(0, len(of), step):
                    part = of[k : k + step]
                    data = flat[starts[part, None] + np.arange(width)].astype(np.float64)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        data /= np.linalg.norm(data, axis=1, keepdims=True)
                    yield pa.RecordBatch.from_arrays([pa.array([ids[part].tobytes()], pa.binary()), pa.array([width], pa.int32()), pa.array([data.tobytes()], pa.binary())], ["ids", "width", "data"])

    return rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(vector).cast("array<double>")).mapInArrow(run, "ids binary, width int, data binary")


def _first(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best candidates; equal scores go to the smaller id, NaN comes last."""
    order = np.lexsort((row, -np.where(np.isnan(score), -np.inf, score), query))
    query, row, score = query[order], row[order], score[order]
    keep = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[keep], row[keep], score[keep]


def _best(k: int, digits: int):
    """Pairs of packed blocks to each query's k best rows of a task: query_id, id, similarity (null where there is none).

    Held candidates are cut to the k best a query first, and passed on where these alone are many, so
    that memory depends on neither table's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def cut() -> tuple:
            out = _first(*(np.concatenate([h[c] for h in held]) for c in range(3)), k)
            held.clear()
            return out

        def shown(query: np.ndarray, row: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(row), pa.array(score, mask=np.isnan(score))], ["query_id", "id", "similarity"])

        for batch in batches:
            for at in range(batch.num_rows):
                ids, data, query_ids, query_data = (batch.column(c)[at].as_buffer() for c in (0, 2, 3, 5))  # without a copy
                width, query_width = batch.column(1)[at].as_py(), batch.column(4)[at].as_py()
                row, query = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                x, q = np.frombuffer(data).reshape(len(row), width), np.frombuffer(query_data).reshape(len(query), query_width)
                for start in range(0, len(query), STEP):
                    some = q[start : start + STEP]
                    score = np.round(some @ x.T, digits) if width == query_width and width else np.full((len(some), len(row)), np.nan)
                    rest = np.where(np.isnan(score), np.inf, -score)
                    least = np.partition(rest, k - 1, axis=1)[:, k - 1 : k] if k < len(row) else np.inf
                    of, to = np.nonzero(rest <= least)
                    held.append(_first(query[start + of], row[to], score[of, to], k))
                if sum(len(h[0]) for h in held) > HELD:
                    best = cut()
                    if len(best[0]) > HELD // 2:
                        yield shown(*best)
                    else:
                        held.append(best)
        if held:
            yield shown(*cut())

    return run


def nearest_each(rows: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", id_col: str = "id", digits: int = 12) -> DataFrame:
    """The k rows nearest to each query (query_id, query): query_id, the id, similarity (rounded) and rank.  Ties go to the smaller id.

    Queries are a stated set, taken in blocks against blocks of rows: a product of two matrices each, of
    which a task passes on k rows a query.  Both are dealt out first, rows eight times as widely, since a
    small file would be one task.  Without queries or rows the result is empty; vectors of length
    0, of another width, null or with a null in them have no similarity and come last; a null id is no row.
    """
    parts = 2 * rows.sparkSession.sparkContext.defaultParallelism
    packed = _packed(rows.select(id_col, vector).repartition(parts), id_col, vector)
    asked = _packed(queries.select("query_id", "query").repartition(max(1, parts // 8)), "query_id", "query").toDF("query_ids", "query_width", "query_data")
    near = packed.crossJoin(asked).mapInArrow(_best(k, digits), "query_id long, id long, similarity double").withColumnRenamed("id", id_col)
    w = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("similarity"), id_col)
    return near.withColumn("similarity", F.round("similarity", digits)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
