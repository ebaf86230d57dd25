"""Projects: candidates of the same name, the decision, and where each was seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.resolve import AUTO, FLOOR, LEAD, PROJECT_FLOOR, PROJECT_TOP, TOP, cost_agrees, place_agrees, project_score, year_agrees
from tessera.operators.similarity import top_similar
from tessera.operators.upsert import upsert_sightings, with_ids
from tessera.storage import written

#: Candidates that a task scores on average at most, each with up to PROJECT_TOP pairs.
CANDIDATE_ROWS = 50_000
#: Columns of a project that a candidate has too.
PLACE = ("city", "county", "state")


def find_candidates(candidates: DataFrame, projects: DataFrame, k: int = PROJECT_TOP, floor: float = PROJECT_FLOOR) -> DataFrame:
    """The k projects whose names are most like each candidate's: key, candidate, sim.  candidates: id, name."""
    near = top_similar(candidates.select("id", "name"), projects.select("id", "name"), k, floor)
    return near.select(F.col("left_id").alias("key"), F.col("right_id").alias("candidate"), "sim")


def _cost(prefix: str) -> Column:
    """The estimate, else the cost; 0 counts as none."""
    some = lambda c: F.nullif(F.col(f"{prefix}.{c}"), F.lit(0))
    return F.coalesce(some("estimated_cost_usd"), some("cost_usd"))


def score_candidates(pairs: DataFrame, candidates: DataFrame, projects: DataFrame) -> DataFrame:
    """pairs: key, candidate, sim.  Adds score, by name, place, cost and year.

    Pairs come from joins on names, which may be few; they are dealt out by key into as many partitions
    as there are candidates for, and what follows a key (the decision) needs no other exchange.
    """
    wanted = ["id", *PLACE, "cost_usd", "estimated_cost_usd", "year_completed"]
    parts = max(pairs.sparkSession.sparkContext.defaultParallelism, -(-candidates.count() // CANDIDATE_ROWS))
    p = projects.select(*wanted).alias("p")
    c = candidates.select(*wanted).repartition(parts, "id").alias("c")
    far = pairs.alias("x").join(p, F.col("x.candidate") == F.col("p.id")).select("x.key", "x.candidate", "x.sim", F.struct(*(F.col(f"p.{w}").alias(w) for w in wanted)).alias("p"))
    both = far.repartition(parts, "key").alias("x").join(c, F.col("x.key") == F.col("c.id"))
    place = place_agrees({k: F.col(f"c.{k}") for k in PLACE}, {k: F.col(f"p.{k}") for k in PLACE})
    score = project_score(F.col("sim"), place, cost_agrees(_cost("c"), _cost("p")), year_agrees(F.col("c.year_completed"), F.col("p.year_completed")))
    return both.select("x.key", "x.candidate", "x.sim", score.alias("score"))


def decide(scored: DataFrame) -> DataFrame:
    """scored: key, candidate, sim, score.  key, decision (auto, tiebreak or create), candidate (the best), sim, score, and the five best as ``best``."""
    w = Window.partitionBy("key").orderBy(F.desc("score"), "candidate")
    ranked = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP)
    best = ranked.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "candidate", "sim", "score"))).alias("best"))
    top, second = F.col("best")[0], F.get("best", F.lit(1))
    auto = (top["score"] >= AUTO) & (top["sim"] >= AUTO) & (second.isNull() | (second["score"] < top["score"] - LEAD))
    decision = F.when(auto, "auto").when(top["score"] >= FLOOR, "tiebreak").otherwise("create")
    return best.select("key", decision.alias("decision"), top["candidate"].alias("candidate"), top["sim"].alias("sim"), top["score"].alias("score"), "best")


def resolve_projects(candidates: DataFrame, projects: DataFrame, sources: DataFrame, tiebreak: Callable[[DataFrame], DataFrame] | None = None, at: Column | None = None) -> dict[str, DataFrame]:
    """Each candidate matched to a project or made one.

    candidates: id, the columns of projects, source_type, source_ref.  In turn: a source that is known
    gives its project (of several the least id); a sure match; the choice of ``tiebreak`` (from key and
    best to key, candidate, confidence; no row or a null is no choice); else a new project.  Candidates
    of one source are one, the least id speaking for all.  Candidates of a batch are compared with
    the projects before it, not with each other; candidates without a source are each resolved.

    Returns decisions (id, project_id, created, confidence, decision), projects and sources (next versions).
    """
    sourced = (F.coalesce("source_type", F.lit("")) != "") & (F.coalesce(F.col("source_ref").cast("string"), F.lit("")) != "")
    known = sources.groupBy("source_type", "source_ref").agg(F.min_by(F.struct("project_id", F.col("confidence").cast("double").alias("confidence")), "project_id").alias("_known"))
    keys = ["source_type", "source_ref"]
    heads = candidates.where(sourced).groupBy(*keys).agg(F.min("id").alias("_first"))
    rows = candidates.join(heads, keys, "left").withColumn("_head", F.coalesce("_first", "id")).drop("_first")
    rows = written(rows.join(known, keys, "left"))
    new = rows.where("_known is null and id = _head")
    scored = score_candidates(find_candidates(new, projects), new, projects)
    decided = written(decide(scored))
    sure = decided.where("decision = 'auto'").select("key", F.col("candidate").alias("_to"), F.col("score").alias("_sure"), "decision")
    if tiebreak:
        chosen = tiebreak(decided.where("decision = 'tiebreak'").select("key", "best")).where("candidate is not null")
        sure = sure.unionByName(chosen.select("key", F.col("candidate").cast("long").alias("_to"), F.col("confidence").cast("double").alias("_sure"), F.lit("tiebreak").alias("decision")))
    matched = new.select(F.col("id").alias("_head")).join(sure.withColumnRenamed("key", "_head"), "_head", "left")
    start = projects.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = new.join(matched.where("_to is null").select("_head"), "_head", "left_semi")
    made = written(with_ids(fresh.withColumnRenamed("id", "_candidate"), ["_candidate"], start))
    own = made.select(F.col("_candidate").alias("_head"), F.col("id").alias("_made"))
    out = rows.select("id", "_head", "_known", "source_type", "source_ref", sourced.alias("_sourced")).join(matched, "_head", "left").join(own, "_head", "left")
    project = F.coalesce("_known.project_id", "_to", "_made")
    confidence = F.coalesce("_known.confidence", "_sure", F.lit(1.0))
    decision = F.when(F.col("_known").isNotNull(), "known").otherwise(F.coalesce("decision", F.lit("create")))
    out = written(out.select("id", project.alias("project_id"), (F.col("_made").isNotNull() & (F.col("id") == F.col("_head"))).alias("created"), confidence.alias("confidence"), decision.alias("decision"), "source_type", "source_ref", "_sourced"))
    now = F.current_timestamp() if at is None else at
    seen = out.where("_sourced and decision <> 'known'").select("project_id", "source_type", F.col("source_ref").cast("string").alias("source_ref"), now.alias("first_seen"), now.alias("last_seen"), F.col("confidence").cast(sources.schema["confidence"].dataType).alias("confidence"))
    columns = [F.col(c) if c in made.columns else F.lit(None).cast(projects.schema[c].dataType).alias(c) for c in projects.columns]
    return {"decisions": out.drop("_sourced", "source_type", "source_ref"), "projects": projects.unionByName(made.select(*columns)), "sources": upsert_sightings(sources, seen, ["project_id", "source_type", "source_ref"])}
