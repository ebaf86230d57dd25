"""Versioned extraction: which probe runs are due, what the latest outputs say, and the rows they make."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import clean_byline, content_hash, extract_scope, parse_amount, parse_square_feet, safe_int, state_code, strip_fence
from tessera.storage import written

#: The fields of the answers.
PANEL = (
    "struct<summary: string, author: string, project: struct<name: string, typology: string, location: string, city: string, state: string, cost: string, square_footage: string, stories_levels: string, "
    "delivery_method: string, year_completed: string, status: string>, design_team: array<struct<role: string, firm: string>>, construction_team: array<struct<role: string, firm: string>>, owner: string, owner_rep: string, developer: string>"
)
CLAIMS = "struct<claims: array<struct<text: string, type: string, page: string>>>"
QUOTES = "struct<quotes: array<struct<text: string, speaker_name: string, speaker_title: string, speaker_firm: string, page: string>>>"


@dataclass(frozen=True)
class Probe:
    name: str
    version: int
    prompt: str
    schema: str
    model: str = "external"


REGISTRY = (
    Probe("project_panel", 4, "Describe the one project of this article as JSON: a short summary, the author's bare name, the project's name and facts, its owner, and both teams as lists of role and firm.", PANEL),
    Probe("claims", 3, "List up to 15 claims of fact that this article makes about its project as JSON: text, type and page.", CLAIMS),
    Probe("quotes", 3, "List up to 12 verbatim quotes of this article as JSON: text, speaker's name, title and firm, and page.", QUOTES),
)
#: Kinds of articles that no probe is run on.
NOT_PROBED = ("advertisement", "column", "other")
#: The words that answers are asked to keep to.
TYPOLOGIES = ("K-12", "higher_ed", "healthcare", "industrial", "multifamily", "mixed_use", "office", "aviation", "hospitality", "civic", "religious", "recreation", "infrastructure", "senior_living", "retail", "other")
CLAIM_TYPES = ("stat", "milestone", "challenge", "award", "first", "other")
STATUSES = ("completed", "under_construction", "announced")
#: A probe for columns, outside of the registry until columns are probed.
COLUMN_PROBE = Probe("column", 1, "Summarise this column in two or three sentences as JSON, with its kind, themes, and the firms, people and projects that it names.", "struct<summary: string, column_type: string, themes: array<string>, firms: array<string>, people: array<string>, projects: array<string>>")
#: Most entries that a probe asks for.
MOST = {"claims": 15, "quotes": 12}


def register(known: DataFrame, probes: DataFrame) -> DataFrame:
    """The registry with probes whose (name, version) it lacks."""
    return known.unionByName(probes.join(known.select("name", "version"), ["name", "version"], "left_anti").select(*known.columns))


def due(probes: DataFrame, articles: DataFrame, runs: DataFrame) -> DataFrame:
    """Every (probe, article) without a run of that version over that content."""
    work = articles.crossJoin(probes.select("probe_id", "version"))
    done = runs.select("probe_id", "article_id", F.col("probe_version").alias("version"), F.coalesce("content_hash", F.lit("")).alias("_hash"))
    return work.withColumn("_hash", F.coalesce("content_hash", F.lit(""))).join(done, ["probe_id", "article_id", "version", "_hash"], "left_anti").drop("_hash")


class Transient(Exception):
    """A failure of an external service that may pass: a limit of its rate, a lost connection, an error of its own."""


def retrying(call: Callable, attempts: int = 8, first: float = 10.0, most: float = 120.0, passing: tuple[type[Exception], ...] = (Transient, ConnectionError, TimeoutError), wait: Callable[[float], None] | None = None) -> Callable:
    """The call, repeated after failures that may pass, with waits that double from ``first`` to ``most`` seconds."""
    import time

    def run(*args, **kwargs):
        for k in range(attempts):
            try:
                return call(*args, **kwargs)
            except passing:
                if k == attempts - 1:
                    raise
                (wait or time.sleep)(min(most, first * 2**k))

    return run


def run_external(work: DataFrame, call: Callable[[str], str], text: str = "text") -> DataFrame:
    """The work with ``output``: the external call's answer; a failure is kept as an ``_error`` output."""
    import json

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            out = []
            for t in rows[text]:
                try:
                    out.append(call(t))
                except Exception as e:  # noqa: BLE001  the failure is the row's result
                    out.append(json.dumps({"_error": str(e)}))
            yield rows.assign(output=out)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema)
    return work.mapInPandas(run, f"{schema}, output string")


def rendered(prompt: Column | str, title: Column | str, first_page: Column | str, pages: Column | str, images: Column | str | None = None) -> Column:
    """One message: the prompt, the article's title if it has one, its pages' texts (array) under their numbers, and its images' addresses (array) if given."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    number = lambda i: (c(first_page) + i).cast("string")
    head = F.when(F.coalesce(c(title), F.lit("")) != "", F.concat(F.lit("--- Article title: "), c(title), F.lit(" ---")))
    texts = F.transform(c(pages), lambda t, i: F.concat(F.lit("--- Page "), number(i), F.lit(" (extracted text) ---\n"), F.coalesce(t, F.lit(""))))
    parts = [F.array(c(prompt), head), texts]
    if images is not None:
        parts.append(F.coalesce(F.transform(c(images), lambda u, i: F.concat(F.lit("--- Page "), number(i), F.lit(" (image) ---\n"), u)), F.array().cast("array<string>")))
    return F.array_join(F.filter(F.concat(*parts), lambda x: x.isNotNull()), "\n\n")


def tolerant_json(output: Column | str) -> Column:
    """The output as JSON, closed where it was cut off; what stays unreadable becomes an ``_error`` output with its first 1,000 characters.  Whole JSON stays in the JVM."""
    c = F.col(output) if isinstance(output, str) else output
    fixed = F.pandas_udf(repair_json, "string")
    error = F.to_json(F.struct(F.lit("no JSON").alias("_error"), F.left(c, F.lit(1000)).alias("_raw")))
    bare = strip_fence(c)
    whole = F.try_parse_json(bare).isNotNull()
    return F.when(c.isNull() | whole, bare).otherwise(F.coalesce(fixed(F.when(~whole, c)), error))


def run_probes(probes: DataFrame, articles: DataFrame, runs: DataFrame, call: Callable[[str], str], model: str = "external", at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Runs what is due and appends it.  The runs' next version, and stats: outcome (runs, cache_hits, errors), n.

    probes: id, name, version, prompt, active; articles: id, title, article_type, page_start, pages (array of texts),
    content_hash (null: that of the pages); runs: probe_id, article_id, probe_version, model, content_hash, output_json, ran_at.
    A failed call leaves no run, so that it is due again; an answer that is no JSON is kept as an error.
    """
    import json

    some = articles.where(F.col("article_type").isNull() | ~F.col("article_type").isin(*NOT_PROBED))
    some = some.withColumn("content_hash", F.coalesce("content_hash", content_hash("pages"))).withColumnRenamed("id", "article_id")
    asked = probes.where("active").withColumnRenamed("id", "probe_id")
    work = due(asked, some.select("article_id", "content_hash"), runs)
    told = work.join(asked.select("probe_id", "prompt"), "probe_id").join(some.select("article_id", "title", "page_start", "pages"), "article_id")
    told = told.select("probe_id", "article_id", "version", "content_hash", rendered("prompt", "title", "page_start", "pages").alias("text"))

    def guarded(text: str) -> str:
        try:
            return call(text)
        except Exception as e:  # noqa: BLE001  one article's failure stops no other
            return json.dumps({"_failed": str(e)})

    answers = written(run_external(told, guarded).drop("text"))
    failed = F.get_json_object("output", "$._failed").isNotNull()
    done = answers.where(~F.coalesce(failed, F.lit(False)))
    new = done.select("probe_id", "article_id", F.col("version").alias("probe_version"), F.lit(model).alias("model"), "content_hash", tolerant_json("output").alias("output_json"), (F.current_timestamp() if at is None else at).alias("ran_at"))
    counts = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("outcome"), "n")
    pairs = some.agg(F.count("*").alias("x")).crossJoin(asked.agg(F.count("*").alias("y"))).crossJoin(answers.agg(F.count("*").alias("z")))  # a row each
    hits = pairs.select(F.lit("cache_hits").alias("outcome"), (F.col("x") * F.col("y") - F.col("z")).alias("n"))
    stats = counts(done, "runs").unionByName(hits).unionByName(counts(answers.where(failed), "errors"))
    return runs.unionByName(new, allowMissingColumns=True), stats


def repair_json(text: pd.Series) -> pd.Series:
    """Closes strings, brackets and braces that a truncated answer left open, and drops trailing commas."""
    import json
    import re

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = re.sub(r"^```(?:json)?\s*|\s*```$", "", t.strip())
        for _ in range(3):
            try:
                return json.dumps(json.loads(t))
            except ValueError:
                stack, inside, skip = [], False, False
                for c in t:
                    if skip:
                        skip = False
                    elif inside:
                        inside, skip = c != '"', c == "\\"
                    elif c == '"':
                        inside = True
                    elif c in "[{":
                        stack.append("]" if c == "[" else "}")
                    elif c in "]}" and stack:
                        stack.pop()
                t = t + '"' * inside
                t = re.sub(r",\s*$", "", t) + "".join(reversed(stack))
                t = re.sub(r",\s*([\]}])", r"\1", t)
        return None

    return text.map(one)


def latest(runs: DataFrame, keys: list[str], at: str = "ran_at", output: str = "output") -> DataFrame:
    """The last output of each key that is no error: keys, ``at``, ``output``; combined in each task before the shuffle."""
    ok = runs.where(F.get_json_object(F.col(output), "$._error").isNull())
    return ok.groupBy(*keys).agg(F.max(F.struct(at, output)).alias("_last")).select(*keys, f"_last.{at}", f"_last.{output}")


def parsed(output: Column | str, schema: str) -> Column:
    return F.from_json(strip_fence(output), schema)


def within_caps(probe: str, items: Column) -> Column:
    """Whether an answer keeps to the most entries that its probe asks for: a check beside it, which drops nothing."""
    return F.size(items) <= MOST[probe]


def unwrapped(output: Column | str, items: str, names: tuple[str, ...] = ("segments", "articles")) -> Column:
    """A bare list, or the list under one of the names."""
    c = strip_fence(output)
    return F.coalesce(*(F.from_json(c, f"struct<{n}: {items}>")[n] for n in names), F.from_json(c, items))


def in_vocabulary(value: Column | str, words: tuple[str, ...]) -> Column:
    """Whether an answer keeps to the words it was asked for; null is allowed.  A check beside it, which changes nothing."""
    c = F.col(value) if isinstance(value, str) else value
    return c.isNull() | c.isin(*words)


def team_roles(panel: Column) -> Column:
    """(firm, role, team, scope) of the owner and both teams; entries without a role or firm are left out."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""

    def entry(role: Column, firm: Column, team: str) -> Column:
        (r, rs), (f, fs) = extract_scope(role), extract_scope(firm)
        return F.struct(f.alias("firm"), r.alias("role"), F.lit(team).alias("team"), F.nullif(F.concat_ws("; ", rs, fs), F.lit("")).alias("scope"))

    none = F.array().cast("array<struct<firm: string, role: string, team: string, scope: string>>")
    owner = F.when(blank(panel["owner"]), none).otherwise(F.array(entry(F.lit("Owner"), panel["owner"], "owner")))
    of = lambda name, team: F.coalesce(F.transform(F.filter(panel[name], lambda x: ~blank(x["role"]) & ~blank(x["firm"])), lambda x: entry(x["role"], x["firm"], team)), none)
    return F.concat(owner, of("design_team", "design"), of("construction_team", "construction"))


def candidate(panel: Column) -> list[Column]:
    """The project's columns from a panel."""
    p = panel["project"]
    return [p["name"].alias("name"), p["typology"].alias("typology"), p["location"].alias("location"), p["city"].alias("city"), state_code(p["state"]).alias("state"), p["cost"].alias("cost"), parse_amount(p["cost"]).alias("cost_usd"), p["square_footage"].alias("square_footage"), parse_square_feet(p["square_footage"]).alias("sq_ft"), safe_int(p["year_completed"], 1800, 2100).alias("year_completed"), p["status"].alias("status")]


def materialize(outputs: DataFrame) -> dict[str, DataFrame]:
    """outputs: article_id, probe, output (the latest).  Rows of projects, roles, claims, quotes and articles (summary, author), by article."""
    of = lambda probe, schema: outputs.where(F.col("probe") == probe).select("article_id", F.from_json(tolerant_json("output"), schema).alias("o"))
    panels = of("project_panel", PANEL)
    roles = panels.select("article_id", F.explode(team_roles(F.col("o"))).alias("r")).select("article_id", "r.*")
    texts = lambda rows, name: rows.select("article_id", F.posexplode(F.col("o")[name]).alias("pos", "x")).where("trim(x.text) <> ''")
    page = safe_int("x.page", 1, 10_000).alias("page")
    return {
        "projects": panels.where("trim(o.project.name) <> ''").select("article_id", *candidate(F.col("o"))),
        "roles": roles,
        "articles": panels.select("article_id", F.col("o.summary").alias("summary"), clean_byline("o.author").alias("author")),
        "claims": texts(of("claims", CLAIMS), "claims").select("article_id", "pos", "x.text", "x.type", page),
        "quotes": texts(of("quotes", QUOTES), "quotes").select("article_id", "pos", "x.text", "x.speaker_name", "x.speaker_title", "x.speaker_firm", page),
    }


def issue_state(issues: DataFrame, articles: DataFrame, incoming: DataFrame, reprocess: bool = False) -> DataFrame:
    """incoming: filename.  What to do with each: fresh, resume (an issue without articles), reprocess or skip."""
    counts = articles.groupBy("issue_id").agg(F.count("*").alias("n"))
    rows = incoming.join(issues.select(F.col("id").alias("issue_id"), "filename"), "filename", "left").join(counts, "issue_id", "left")
    state = F.when(F.col("issue_id").isNull(), "fresh").when(F.coalesce("n", F.lit(0)) == 0, "resume").otherwise("reprocess" if reprocess else "skip")
    return rows.select("filename", "issue_id", F.coalesce("n", F.lit(0)).alias("n_articles"), state.alias("state"))
