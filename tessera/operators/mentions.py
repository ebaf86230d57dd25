"""Mentions of firms and people: matched as they come, logged, and swept again later.

Mentions are handled as a set, with the results that one after the other in the order of their ids would
give: a mention matches the best entity known before it, which may be one that an earlier mention made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import normalize_firm, normalize_person
from tessera.operators import resolve
from tessera.operators.similarity import similar_names
from tessera.operators.upsert import first_by_key, insert_if_absent, with_ids
from tessera.storage import discard, written

#: Kinds of entities: normaliser, scope, whether a name that normalises to nothing matches nothing.
KINDS = {"firm": (normalize_firm, [], False), "person": (normalize_person, ["firm_id"], True)}


def _same_scope(a: str, b: str, scope: list[str]) -> Column:
    on = F.lit(True)
    for s in scope:
        on = on & F.col(f"{a}.{s}").eqNullSafe(F.col(f"{b}.{s}"))
    return on


def leaders(names: DataFrame, normalize: Callable[[Column | str], Column] = normalize_firm, scope: list[str] = (), floor: float = resolve.AUTO) -> DataFrame:
    """names: id, name and the scope's columns, none of which matches a known entity.  id, leader, sim (null for a leader itself).

    In the order of ids a name follows the best of the leaders before it, by equal name in any case, by
    equal normal form, then by similarity of at least ``floor`` (ties: least id); with none it leads.

    Equal names are one node.  A round makes followers of all nodes that an earlier leader fits, and
    leaders of those whose earlier neighbours are all followers; each settles at least the earliest node
    left, so the loop ends, and a group of like names takes two rounds whatever its size.
    """
    scope = list(scope)
    rows = written(names.where("name is not null").select("id", "name", *scope, F.lower("name").alias("low"), normalize("name").alias("norm")))
    nodes = written(rows.groupBy(*scope, "low").agg(F.min("id").alias("node"), F.min_by("name", "id").alias("name"), F.min_by("norm", "id").alias("norm")))
    edges = written(similar_names(nodes.select(F.col("node").alias("id"), "name", *scope), nodes.select(F.col("node").alias("id"), "name", *scope), floor, same=True, scope=scope))
    # a group of one normal form; nodes without one are groups of their own
    key = F.when(F.col("norm") != "", F.concat(F.lit("g"), "norm")).otherwise(F.concat(F.lit("n"), F.col("node").cast("string")))
    nodes = nodes.withColumn("form", key)
    state = written(nodes.select("node", "form", *scope, F.lit(None).cast("boolean").alias("leads")))
    while state.where("leads is null").limit(1).count():
        s, group = state.alias("s"), ["form", *scope]
        found = state.groupBy(*group).agg(F.min(F.when(F.col("leads"), F.col("node"))).alias("first_leader"), F.min(F.when(F.col("leads").isNull(), F.col("node"))).alias("first_open")).alias("g")
        known = state.select(F.col("node").alias("left_id"), "leads")
        near = edges.join(known, "left_id").groupBy(F.col("right_id").alias("node")).agg(F.max(F.coalesce("leads", F.lit(False))).alias("led"), F.max(F.col("leads").isNull()).alias("open"))
        joined = s.join(found, (F.col("s.form") == F.col("g.form")) & _same_scope("s", "g", scope)).join(near.alias("n"), F.col("s.node") == F.col("n.node"), "left")
        led = F.coalesce("led", F.lit(False)) | F.coalesce(F.col("first_leader") < F.col("s.node"), F.lit(False))
        waits = F.coalesce("open", F.lit(False)) | (F.col("first_open") < F.col("s.node"))
        leads = F.coalesce("leads", F.when(led, False).when(~waits, True))
        last, state = state, written(joined.select("s.node", "s.form", *(f"s.{c}" for c in scope), leads.alias("leads")))
        discard(last)
    heads = state.where("leads").select("node").join(nodes.drop("form"), "node").alias("h")
    m = rows.alias("m")
    pick = lambda joined, stage, sim: joined.where(F.col("h.node") < F.col("m.id")).select(F.col("m.id").alias("id"), F.struct(F.lit(stage).alias("stage"), (-sim).alias("far"), F.col("h.node").alias("leader")).alias("hit"))
    hits = pick(m.join(heads, (F.col("m.low") == F.col("h.low")) & _same_scope("m", "h", scope)), 0, F.lit(1.0))
    hits = hits.unionByName(pick(m.where("norm <> ''").join(heads, (F.col("m.norm") == F.col("h.norm")) & _same_scope("m", "h", scope)), 1, F.lit(1.0)))
    # likeness is of nodes: each mention of a node has that of its node
    both = edges.select("left_id", "right_id", "sim").unionByName(edges.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "sim"))
    own = m.join(nodes.select("node", "low", *scope).alias("o"), (F.col("m.low") == F.col("o.low")) & _same_scope("m", "o", scope))
    like = own.join(both.alias("e"), F.col("o.node") == F.col("e.left_id")).join(heads, F.col("e.right_id") == F.col("h.node"))
    hits = hits.unionByName(pick(like, 2, F.col("e.sim")))
    best = hits.groupBy("id").agg(F.min("hit").alias("hit"))
    return rows.join(best, "id", "left").select("id", F.coalesce("hit.leader", "id").alias("leader"), (-F.col("hit.far")).alias("sim"))


def ingest(mentions: DataFrame, entities: DataFrame, kind: str = "firm") -> tuple[DataFrame, DataFrame]:
    """mentions: id, name (person: title, firm_id); entities: id, name, aliases (person: firm_id).  The entities' next version, and the log.

    A mention that nothing matches makes a placeholder; its confidence is null, which asks for a sweep.
    Every mention is logged: id, name, canonical_id, confidence, corrected.  A person without a name
    is no mention; nor is a firm whose name is null.
    """
    normalize, scope, blocks = KINDS[kind]
    mentions = mentions.where("trim(name) <> ''" if kind == "person" else "name is not null")
    match = resolve.match_people(mentions, entities, normalize) if kind == "person" else resolve.match_firms(mentions, entities, normalize)
    match = written(match.select("id", "match_id", "confidence"))
    left = mentions.join(match.where("match_id is null").select("id"), "id", "left_semi")
    # a name that normalises to nothing can only be equal to another
    led = written(leaders(left.select("id", "name", *scope), normalize, scope) if not blocks else _led_people(left, normalize, scope))
    fresh = left.join(led.where("id = leader").select("id"), "id", "left_semi")
    start = entities.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = written(with_ids(fresh.withColumnRenamed("id", "_mention"), ["_mention"], start))
    kept = [F.col(c) if c in new.columns else F.lit(None).cast(entities.schema[c].dataType).alias(c) for c in entities.columns]
    kept = [F.array().cast("array<string>").alias("aliases") if c == "aliases" else k for c, k in zip(entities.columns, kept, strict=True)]
    made = led.join(new.select(F.col("_mention").alias("leader"), F.col("id").alias("_made")), "leader")
    log = mentions.select("id", "name").join(match, "id").join(made.select("id", "_made", "sim"), "id", "left")
    log = log.select("id", "name", F.coalesce("match_id", "_made").alias("canonical_id"), F.coalesce("confidence", "sim").alias("confidence"), F.lit(False).alias("corrected"))
    return entities.unionByName(new.select(*kept)), log


def _led_people(left: DataFrame, normalize: Callable, scope: list[str]) -> DataFrame:
    """As leaders; people whose names normalise to nothing follow only an equal name."""
    empty = normalize("name") == ""
    named = leaders(left.where(~empty).select("id", "name", *scope), normalize, scope)
    w = Window.partitionBy("name", *scope)
    return named.unionByName(left.where(empty).select("id", F.min("id").over(w).alias("leader")).select("id", "leader", F.lit(None).cast("double").alias("sim")))


def firm_of(mentions: DataFrame, firms: DataFrame, raw_firm: str = "raw_firm") -> DataFrame:
    """Mentions with firm_id of the firm of that very name, in any case (ties: least id); null without one."""
    known = firms.groupBy(F.lower("name").alias("_firm")).agg(F.min("id").alias("firm_id"))
    return mentions.drop("firm_id").join(known, F.lower(raw_firm) == F.col("_firm"), "left").drop("_firm")


def sweep(log: DataFrame, entities: DataFrame, kind: str = "firm", decide: Callable[[DataFrame], DataFrame] | None = None, redo: bool = False, limit: int | None = None) -> dict[str, DataFrame]:
    """Resolves the mentions that are still open.  log: id, name, canonical_id, confidence, corrected (person: firm_id).

    What the cascade matches is written; the rest goes, with its candidates, to ``decide``, which gives
    raw, decision (match, new or else), canonical_id, canonical_name, confidence, the last of a raw
    winning by its column ``pos`` if it has one.  ``new`` makes a firm unless there is one of that name in any case; for people it
    only confirms the placeholder they have.  Returns entities, log and stats (outcome, n).
    """
    normalize, scope, _ = KINDS[kind]
    open_ = log if redo else log.where(resolve.unresolved())
    open_ = written(open_.orderBy("id").limit(limit) if limit else open_)
    match = resolve.match_people if kind == "person" else resolve.match_firms
    # a placeholder is no match for its own mention
    targets = entities.select("id", "name", "aliases", *scope)
    found = written(match(open_.select("id", "name", *scope), targets, normalize))
    sure = found.where("match_id is not null").select("id", F.col("match_id").alias("to"), F.col("confidence").alias("sure"), F.lit("resolved_deterministic").alias("outcome"))
    rest = found.where("match_id is null").join(open_.select("id", F.col("name").alias("raw"), "canonical_id"), "id")
    new_entities = entities
    if decide is None:
        told = rest.select("id", F.lit(None).cast("long").alias("to"), F.lit(None).cast("double").alias("sure"), F.lit("ambiguous").alias("outcome"))
    else:
        said = decide(rest.select("id", "raw", "candidates"))
        said = said.withColumn("pos", F.lit(0)) if "pos" not in said.columns else said
        said = said.groupBy("raw").agg(F.max_by(F.struct("decision", F.col("canonical_id").alias("said_id"), F.trim("canonical_name").alias("said_name"), F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("said_confidence")), "pos").alias("d")).select("raw", "d.*")
        told = written(rest.join(said, "raw", "left"))
        if kind == "firm":
            create = told.where("decision = 'new' and said_name <> ''").groupBy(F.lower("said_name").alias("low")).agg(F.min_by("said_name", "id").alias("name"))
            create = create.join(entities.select(F.lower("name").alias("low")), "low", "left_anti")
            start = entities.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
            made = with_ids(create.select("name"), ["name"], start)
            new_entities = written(entities.unionByName(made.withColumn("aliases", F.array().cast("array<string>")), allowMissingColumns=True).select(*entities.columns))
            by_name = new_entities.groupBy(F.lower("name").alias("low")).agg(F.min("id").alias("named"))
            told = told.join(by_name, F.lower("said_name") == F.col("low"), "left")
        else:
            told = told.withColumn("named", F.col("canonical_id"))
        told = told.join(new_entities.select(F.col("id").alias("said_id"), F.lit(True).alias("real")), "said_id", "left")
        to = F.when((F.col("decision") == "match") & F.col("real"), F.col("said_id")).when((F.col("decision") == "new") & ((F.col("said_name") != "") if kind == "firm" else F.lit(True)), F.col("named"))
        outcome = F.when(F.col("decision").isNull(), "ambiguous").when(to.isNull(), "skipped").when(F.col("decision") == "match", "resolved_llm").otherwise("created")
        told = told.select("id", to.alias("to"), F.when(to.isNotNull(), F.col("said_confidence")).alias("sure"), outcome.alias("outcome"))
    done = written(sure.unionByName(told))
    next_log = log.join(done.select("id", "to", "sure"), "id", "left")
    next_log = next_log.withColumn("canonical_id", F.coalesce("to", "canonical_id")).withColumn("confidence", F.when(F.col("to").isNotNull(), F.col("sure")).otherwise(F.col("confidence"))).select(*log.columns)
    raws = done.where("to is not null").join(open_.select("id", "name"), "id").groupBy(F.col("to").alias("id")).agg(F.collect_set("name").alias("_raws"))
    return {"entities": with_aliases(new_entities, raws), "log": next_log, "stats": done.groupBy("outcome").agg(F.count("*").alias("n"))}


def with_aliases(entities: DataFrame, raws: DataFrame) -> DataFrame:
    """Entities with the raw forms (id, _raws) that are neither their name nor an alias yet put behind their aliases, in order."""
    own = F.coalesce("aliases", F.array().cast("array<string>"))
    more = F.sort_array(F.array_except(F.coalesce("_raws", F.array().cast("array<string>")), F.array_append(own, F.col("name"))))
    return entities.join(raws, "id", "left").withColumn("aliases", F.concat(own, more)).select(*entities.columns)


def get_or_create(firms: DataFrame, names: DataFrame) -> DataFrame:
    """Firms with those names (name) that no firm has, in any case, under new ids; the first by name of each."""
    fresh = names.where("trim(name) <> ''").select(F.trim("name").alias("name"), F.lower(F.trim("name")).alias("_low"))
    fresh = first_by_key(fresh, ["_low"], ["name"]).join(firms.select(F.lower("name").alias("_low")), "_low", "left_anti")
    start = firms.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return insert_if_absent(firms, with_ids(fresh.select("name"), ["name"], start), ["name"], ["id"])
