"""Generated SQL, run read-only over named tables; and comparable projects."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.vectors import cosine

_READS = re.compile(r"^\s*(?:WITH|SELECT)\b", re.IGNORECASE)
_FENCE = re.compile(r"^```(?:sql)?\s*|\s*```$", re.IGNORECASE)


def ask(spark: SparkSession, sql: str, tables: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """The rows of one SELECT over the tables given.  Raises ValueError for anything else.

    Spark's parser takes one statement only; INSERT after WITH is turned down by its plan, no node of which may be a command or statement.
    """
    text = _FENCE.sub("", sql.strip()).rstrip("; \n")
    if not _READS.match(text):
        raise ValueError("only SELECT or WITH … SELECT is run")
    logical = "org.apache.spark.sql.catalyst.plans.logical"
    kinds = [spark._jvm.java.lang.Class.forName(f"{logical}.{name}") for name in ("Command", "ParsedStatement")]
    nodes = [spark._jsparkSession.sessionState().sqlParser().parsePlan(text)]
    while nodes:
        node = nodes.pop()
        if any(kind.isInstance(node) for kind in kinds):
            raise ValueError("only SELECT or WITH … SELECT is run")
        nodes += [node.children().apply(k) for k in range(node.children().length())]
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    out = spark.sql(text)
    return out.limit(limit) if limit else out


def comparable(projects: DataFrame, query: list[float], k: int, where: Column | None = None, vector: str = "embedding") -> DataFrame:
    """The k projects most like one by its vector, among those that pass the filter."""
    rows = projects if where is None else projects.where(where)
    return rows.withColumn("similarity", cosine(F.col(vector), F.array(*(F.lit(float(x)) for x in query)))).orderBy(F.desc_nulls_last("similarity"), "id").limit(k)


def alerts(watches: DataFrame, sightings: DataFrame, since: str) -> DataFrame:
    """New sightings of watched projects: watches: watch_id, project_id; sightings: project_id, source_ref, first_seen."""
    return sightings.where(F.col("first_seen") > F.to_timestamp(F.lit(since))).join(watches, "project_id").select("watch_id", "project_id", "source_ref", "first_seen")
