"""Entity resolution: a cascade of ever looser matches, and how two projects score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.similarity import top_similar

#: Least similarity of an automatic match and of a candidate; candidates a mention.
AUTO, FLOOR, TOP = 0.92, 0.55, 5
#: Project candidates a project, their least similarity, and the lead that an automatic match needs.
PROJECT_TOP, PROJECT_FLOOR, LEAD = 8, 0.45, 0.15


def _cascade(mentions: DataFrame, entities: DataFrame, normalize: Callable[[str], Column], scope: list[str], empty_blocks: bool) -> DataFrame:
    def scoped(keys: DataFrame, on: Column) -> Column:
        for s in scope:
            on = on & F.col(f"m.{s}").eqNullSafe(F.col(f"e.{s}"))
        return on

    m = mentions.withColumn("_low", F.lower("name")).withColumn("_norm", normalize("name"))
    e = entities.withColumn("_low", F.lower("name")).withColumn("_norm", normalize("name"))
    usable = F.col("m._norm") != "" if empty_blocks else F.lit(True)
    best = lambda keys, on: m.alias("m").join(keys.alias("e"), scoped(keys, on)).where(usable).groupBy("m.id").agg(F.min("e.id").alias("hit"))
    exact = best(e, F.col("m._low") == F.col("e._low"))
    normal = best(e.where("_norm <> ''"), F.col("m._norm") == F.col("e._norm"))
    alias = best(e.select("id", *scope, F.explode("aliases").alias("_alias")), F.col("m._low") == F.lower("e._alias"))
    out = m.select("id", "name", "_norm", *scope)
    for stage, hits in (("exact", exact), ("normalized", normal), ("alias", alias)):
        out = out.join(hits.withColumnRenamed("hit", f"_{stage}"), "id", "left")
    known = F.coalesce("_exact", "_normalized", "_alias")
    rest = out.where(known.isNull() & (F.col("_norm") != "" if empty_blocks else F.lit(True)))  # later stages see only what is left
    near = top_similar(rest.select("id", "name", *scope), entities.select("id", "name", *scope), TOP, FLOOR, scope)
    near = near.groupBy("left_id").agg(F.min_by("right_id", "rank").alias("_near"), F.max("sim").alias("_sim"), F.sort_array(F.collect_list(F.struct("rank", "right_id"))).alias("_c"))
    out = out.join(near.withColumnRenamed("left_id", "id"), "id", "left")
    auto = F.col("_sim") >= AUTO
    stage = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_normalized").isNotNull(), "normalized").when(F.col("_alias").isNotNull(), "alias").when(auto, "trigram").when(F.col("_sim").isNotNull(), "candidates").otherwise("none")
    match = F.coalesce(known, F.when(auto, F.col("_near")))
    confidence = F.when(known.isNotNull(), 1.0).when(auto, F.col("_sim"))
    return out.select("id", match.alias("match_id"), confidence.alias("confidence"), stage.alias("stage"), F.when(stage == "candidates", F.transform("_c", lambda x: x["right_id"])).alias("candidates"))


def match_firms(mentions: DataFrame, firms: DataFrame, normalize: Callable[[str], Column]) -> DataFrame:
    """mentions: id, name; firms: id, name, aliases.  Returns id, match_id, confidence, stage, candidates.

    Exact (in any case), normalised, alias, then trigram of at least AUTO; candidates are what is left at
    FLOOR or more.  Ties go to the least id.
    """
    return _cascade(mentions, firms, normalize, [], False)


def match_people(mentions: DataFrame, people: DataFrame, normalize: Callable[[str], Column], scope: str = "firm_id") -> DataFrame:
    """As match_firms, within an equal scope (null equals null); a name that normalises to nothing matches nothing."""
    return _cascade(mentions, people, normalize, [scope], True)


def unresolved(confidence: str = "confidence", canonical: str = "canonical_id", corrected: str = "corrected", least: float = 0.80) -> Column:
    """Mentions that a sweep looks at."""
    return (F.col(canonical).isNull() | F.col(confidence).isNull() | (F.col(confidence) < least)) & ~F.col(corrected)


def _some(x: Column) -> Column:
    return F.nullif(x, F.lit(0))


def cost_agrees(a: Column, b: Column) -> Column:
    """Within 30 % of the larger; null if either is missing or 0."""
    a, b = _some(a), _some(b)
    return F.when(a.isNotNull() & b.isNotNull(), (F.greatest(a, b) - F.least(a, b)) / F.greatest(a, b) <= 0.30)


def year_agrees(a: Column, b: Column) -> Column:
    return F.abs(_some(a) - _some(b)) <= 2


def place_agrees(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """By city if both have one, else by county, else by state."""
    out = F.lit(None).cast("boolean")
    for part in ("state", "county", "city"):
        x, y = F.lower(F.trim(a[part])), F.lower(F.trim(b[part]))
        out = F.when((x != "") & (y != ""), x == y).otherwise(out)
    return out


def project_score(sim: Column, place: Column, cost: Column, year: Column) -> Column:
    """0.7 of the names' similarity, and gains and losses for what agrees or does not, within 0 and 1."""
    part = lambda c, yes, no: F.when(c.cast("boolean"), yes).when(~c.cast("boolean"), no).otherwise(0.0)
    total = 0.7 * sim + part(place, 0.15, -0.20) + part(cost, 0.05, -0.10) + part(year, 0.05, -0.10)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))
