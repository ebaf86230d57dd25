"""Closures of merges, and who has worked with whom."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.storage import discard, written

#: Roles that a task of teaming gets on average at most.
ROLE_ROWS = 400_000


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (longs).  Returns node, root: the smallest node that links lead to; for nodes with an edge to another.

    Alternating large and small stars: every node passes the least of its neighbours to the larger
    ones, then to the smaller ones, until each component is a star.  Every round is two joins of the
    edge table with one row a node, which AQE splits where a centre has many edges; no neighbour list is
    ever held by a task, and the table of the round before is removed.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct())
    before = None
    while True:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).where("u < v").unionByName(least.select("v", F.col("m").alias("u"))).distinct()
        last, edges = edges, written(small)
        discard(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = now


def merged_roots(pairs: DataFrame) -> DataFrame:
    """pairs: a, b.  Returns id, root for every id in a pair without nulls; the root is the least id that pairs lead to."""
    known = pairs.where("a is not null and b is not null").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    alone = known.where("a = b").select(F.col("a").alias("id")).distinct()
    found = components(known).withColumnRenamed("node", "id")
    return found.unionByName(alone.join(found, "id", "left_anti").withColumn("root", F.col("id")))


def repoint(rows: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Rows with ``column`` led from id to root where mapping (id, root) says so; adds _moved."""
    m = mapping.select(F.col("id").alias("_id"), F.col("root").alias("_to"))
    out = rows.join(m, F.col(column) == F.col("_id"), "left")
    return out.withColumn("_moved", F.coalesce(F.col("_to") != F.col(column), F.lit(False))).withColumn(column, F.coalesce("_to", column)).drop("_id", "_to")


def spread(roles: DataFrame) -> int:
    """So many partitions that a task gets ROLE_ROWS rows on average at most."""
    return max(roles.sparkSession.sparkContext.defaultParallelism, -(-roles.count() // ROLE_ROWS))


def teaming(roles: DataFrame, project: str, firm: str, parts: int = 0, within: list[str] = ()) -> DataFrame:
    """How many projects each pair of firms shares: a, b, n_projects; with ``within``, pairs of one value of these columns alone.

    Roles are dealt out by project into as many partitions as their number asks (``parts``: see spread),
    since partitions joined by their compressed size hold the more rows the more alike these are; what
    is distinct and which pairs there are is found where they lie.
    """
    one = roles.select(F.col(project).alias("p"), F.col(firm).alias("a"), *within).repartition(parts or spread(roles), "p", *within).distinct()
    two = one.withColumnRenamed("a", "b")
    return one.join(two, ["p", *within]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n_projects"))


def migrations(work: DataFrame, firm: str, kind: str, at: str, tie: str) -> DataFrame:
    """Firms whose last project is of another kind than their first: firm, first_kind, last_kind.  Rows without a kind or time do not count."""
    rows = work.where(F.col(kind).isNotNull() & F.col(at).isNotNull())
    order = F.struct(at, tie)
    ends = rows.groupBy(firm).agg(F.min_by(kind, order).alias("first_kind"), F.max_by(kind, order).alias("last_kind"))
    return ends.where("first_kind <> last_kind")
