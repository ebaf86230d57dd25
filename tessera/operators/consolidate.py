"""Merging duplicates: which rows are one entity, and what becomes of the rows that name them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import strip_all_parens, strip_last_paren
from tessera.operators.graph import merged_roots, repoint
from tessera.operators.similarity import similar_names
from tessera.operators.upsert import delete_keys, first_by_key, some_null
from tessera.storage import written


def similar_roots(entities: DataFrame, low: float, high: float = 1.0, same: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """entities: id, name.  id, root over pairs whose similarity is in [low, high], or below high if high < 1.

    same: a tiebreaker from pairs (left_id, right_id, sim) to those that are one entity; by default all are.
    """
    pairs = similar_names(entities, entities, low, same=True)
    pairs = pairs.where(F.col("sim") < high) if high < 1 else pairs
    pairs = same(pairs) if same else pairs
    return merged_roots(pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))


def paren_clusters(firms: DataFrame) -> DataFrame:
    """firms: id, name.  id, root over names equal but for a last parenthesis; the bare name leads, else the least id."""
    key = F.lower(strip_last_paren("name"))
    bare = F.lower(F.trim("name")) == F.col("_key")
    w = Window.partitionBy("_key").orderBy(F.desc("_bare"), "id")
    rows = firms.withColumn("_key", key).withColumn("_bare", bare)
    rows = rows.withColumn("root", F.first("id").over(w)).withColumn("_n", F.count("*").over(Window.partitionBy("_key")))
    return rows.where("_n > 1").select("id", "root")


def redundant_roles(roles: DataFrame) -> DataFrame:
    """roles: id, project_id, firm_id, team, role.  The ids that a bare form of the same role makes redundant, and clusters without one as skipped."""
    rows = roles.withColumn("_key", F.lower(strip_all_parens("role"))).withColumn("_bare", ~F.coalesce(F.col("role"), F.lit("")).contains("("))
    w = Window.partitionBy("project_id", "firm_id", "team", "_key")
    rows = rows.withColumn("_n", F.count("*").over(w)).withColumn("_any", F.max("_bare").over(w)).withColumn("_k", F.row_number().over(w.orderBy(F.desc("_bare"), "id")))
    return rows.where("_n > 1 and _k > 1").select("id", F.when(F.col("_any"), "delete").otherwise("skip").alias("action"))


def merge_children(rows: DataFrame, mapping: DataFrame, column: str, keys: list[str], order: list[str], nulls_distinct: bool = False) -> DataFrame:
    """Child rows led to the roots, without those that collide there: a root's own row stays, else the first by ``order``."""
    moved = repoint(rows, mapping, column)
    if len(order) != 1 or set(rows.columns) != {*keys, *order}:
        return first_by_key(moved, keys, ["_moved", *order], nulls_distinct).drop("_moved")
    # the order is all that rows have beside their key: two least values, aggregated in each task first
    keyed = moved.where(~some_null(keys)) if nulls_distinct else moved
    own = F.min(F.when(~F.col("_moved"), F.col(order[0])))
    least = keyed.groupBy(*keys).agg(F.when(F.min("_moved"), F.min(order[0])).otherwise(own).alias(order[0])).select(*rows.columns)
    return least.unionByName(moved.where(some_null(keys)).select(*rows.columns)) if nulls_distinct else least


def merge_firms(tables: dict[str, DataFrame], mapping: DataFrame) -> dict[str, DataFrame]:
    """The tables after firms (id) merged into roots (mapping: id, root).

    Roles and people are led to the roots; of those that then are one, the root's stays.  What named a
    person that went (quotes, person_mentions) names the one that stayed.  Names become aliases.
    """
    out = dict(tables)
    out["firms"] = merge_entities(tables["firms"], mapping, aliases=True)
    if "roles" in tables:
        out["roles"] = merge_children(tables["roles"], mapping, "firm_id", ["project_id", "firm_id", "role", "team"], ["id"], nulls_distinct=True)
    if "firm_mentions" in tables:
        out["firm_mentions"] = repoint(tables["firm_mentions"], mapping, "canonical_id").drop("_moved")
    if "people" in tables:
        led = repoint(tables["people"], mapping, "firm_id")
        stay = led.groupBy("name", "firm_id").agg(F.min(F.struct("_moved", "id")).alias("_stay"))
        pairs = led.join(stay, led["name"].eqNullSafe(stay["name"]) & led["firm_id"].eqNullSafe(stay["firm_id"])).where("_moved and id <> _stay.id").select("id", F.col("_stay.id").alias("root"))
        pairs = written(pairs)
        out["people"] = led.drop("_moved").join(pairs.select("id"), "id", "left_anti").select(*tables["people"].columns)
        for name, column in (("quotes", "speaker_person_id"), ("person_mentions", "canonical_id")):
            if name in tables:
                out[name] = repoint(tables[name], pairs, column).drop("_moved")
    return out


def split_firm(tables: dict[str, DataFrame], firm: int, name: str, raw_names: list[str]) -> dict[str, DataFrame]:
    """The inverse of a merge: a new firm ``name`` takes those aliases, roles and mentions whose raw form is that name or in raw_names."""
    firms, taken = tables["firms"], sorted({name, *raw_names})
    new_id = firms.agg(F.max("id")).first()[0] + 1
    names = F.array(*map(F.lit, taken))
    rest = firms.withColumn("aliases", F.when(F.col("id") == firm, F.array_except("aliases", names)).otherwise(F.col("aliases")))
    own = {"id": F.lit(new_id), "name": F.lit(name), "aliases": F.array_remove(F.array_intersect("aliases", names), name)}
    made = firms.where(F.col("id") == firm).select(*(own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in firms.schema))
    out = dict(tables) | {"firms": rest.unionByName(made)}
    for table, column, raw in (("roles", "firm_id", "raw_name"), ("firm_mentions", "canonical_id", "raw_text")):
        if table in tables:
            moves = (F.col(column) == firm) & F.col(raw).isin(taken)
            out[table] = tables[table].withColumn(column, F.when(moves, F.lit(new_id)).otherwise(F.col(column)))
    return out


def merge_entities(entities: DataFrame, mapping: DataFrame, inherit: list[str] = (), aliases: bool = False) -> DataFrame:
    """Entities without those that merged: a root inherits the first value it lacks, and with ``aliases`` all names of the others."""
    rows = repoint(entities.withColumn("_root", F.col("id")), mapping, "_root")
    lost = rows.where("_moved").groupBy(F.col("_root").alias("id")).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(f"_{c}") for c in inherit), *([F.flatten(F.collect_list(F.array_append("aliases", F.col("name")))).alias("_aliases")] if aliases else []), F.count("*").alias("_n"))
    out = entities.join(mapping.where("id <> root").select("id"), "id", "left_anti").join(lost, "id", "left")
    for c in inherit:
        out = out.withColumn(c, F.coalesce(c, f"_{c}"))
    if aliases:
        out = out.withColumn("aliases", all_names("aliases", "_aliases", "name"))
    return out.select(*entities.columns)


def all_names(a: str, b: str, own: str) -> Column:
    """The union of two alias arrays without the entity's own name, sorted."""
    return F.array_sort(F.array_except(F.array_union(F.col(a), F.coalesce(F.col(b), F.array().cast("array<string>"))), F.array(F.col(own))))


def check_merge(entities: DataFrame, winner: int, loser: int) -> None:
    """Raises ValueError unless both exist and differ."""
    if winner == loser:
        raise ValueError("winner and loser must be distinct")
    if entities.where(F.col("id").isin(winner, loser)).select("id").distinct().count() < 2:
        raise ValueError("winner or loser not found")


def merge_two(tables: dict[str, DataFrame], entity: str, winner: int, loser: int, children: dict[str, tuple[str, list[str]]], **how) -> dict[str, DataFrame]:
    """The tables after one merge.  children: table -> (column, natural key)."""
    check_merge(tables[entity], winner, loser)
    mapping = tables[entity].sparkSession.createDataFrame([(loser, winner)], "id long, root long")
    out = dict(tables) | {entity: merge_entities(tables[entity], mapping, **how)}
    for name, (column, keys) in children.items():
        order = ["id"] if "id" in tables[name].columns else [c for c in tables[name].columns if c not in keys] or [column]
        out[name] = merge_children(tables[name], mapping, column, keys, order)
    return out


def apply_deletes(rows: DataFrame, planned: DataFrame) -> DataFrame:
    return delete_keys(rows, planned.where("action = 'delete'"), "id")
