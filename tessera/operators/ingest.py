"""From pages to entity tables: batches, segments, articles, probes, and what the answers make."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import content_hash, issue_month, issue_year, page_range
from tessera.operators import mentions, probes, projects, upsert
from tessera.sources import tables as contracts
from tessera.storage import written

#: Pages that are segmented at once; an article does not cross batches.
PAGES = 5
SEGMENTS = "array<struct<page_start: string, page_end: string, title: string, author: string, type: string>>"
ASK = "Divide these pages into articles. Answer as JSON: segments, each with page_start, page_end, title, author and type."


def page_batches(pages: DataFrame, size: int = PAGES) -> DataFrame:
    """pages: issue_id, page, text.  issue_id, batch, first_page, pages (texts in order): runs of ``size`` pages."""
    rows = pages.withColumn("batch", F.floor((F.col("page") - 1) / size).cast("int"))
    grouped = rows.groupBy("issue_id", "batch").agg(F.min("page").alias("first_page"), F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("p"))
    return grouped.select("issue_id", "batch", "first_page", F.transform("p", lambda x: x["text"]).alias("pages"))


def segment(pages: DataFrame, call: Callable[[str], str], size: int = PAGES) -> DataFrame:
    """Articles of the pages by an external segmenter: issue_id, page_start, page_end, title, author, article_type, content_hash, in order of issue, batch and place.

    Pages that are no numbers, or not of the issue, take their defaults; answers that are no list are cut short or empty.
    """
    work = page_batches(pages, size).select("issue_id", "batch", probes.rendered(F.lit(ASK), F.lit(None).cast("string"), "first_page", "pages").alias("text"))
    answers = written(probes.run_external(work, call).drop("text"))
    found = answers.select("issue_id", "batch", F.posexplode(probes.unwrapped(probes.tolerant_json("output"), SEGMENTS)).alias("pos", "s")).where("s is not null")
    last = pages.groupBy("issue_id").agg(F.max("page").alias("n"))
    start, end = page_range("s.page_start", "s.page_end", "n")
    rows = written(found.join(last, "issue_id").select("issue_id", "batch", "pos", start.alias("page_start"), end.alias("page_end"), "s.title", "s.author", F.col("s.type").alias("article_type")))
    # pages of each article: a range join within the issue
    inside = rows.join(pages.select("issue_id", "page", "text"), "issue_id").where("page between page_start and page_end")
    keys = ["issue_id", "batch", "pos"]
    texts = inside.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("p"))
    return rows.join(texts, keys).withColumn("pages", F.transform("p", lambda x: x["text"])).withColumn("content_hash", content_hash("pages")).drop("p")


def new_articles(pages: DataFrame, articles: DataFrame, call: Callable[[str], str]) -> DataFrame:
    """Segments of the pages as articles with new ids, and their pages (array) beside them."""
    start = articles.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return upsert.with_ids(segment(pages, call), ["issue_id", "batch", "pos"], start).drop("batch", "pos")


def reprocess(issues: DataFrame, articles: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Issues and articles that are there already, without loss: years, months and content hashes are filled where null."""
    year, month = issue_year("filename"), issue_month("filename")
    issues = issues.withColumn("year", F.coalesce("year", year)).withColumn("month_label", F.coalesce("month_label", month))
    lacking = articles.where(F.coalesce("content_hash", F.lit("")) == "").select("id", "issue_id", "page_start", "page_end")
    texts = lacking.join(pages, "issue_id").where("page between page_start and page_end").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("p"))
    hashes = texts.select("id", content_hash(F.transform("p", lambda x: x["text"])).alias("content_hash"))
    return issues, upsert.fill_nulls(articles.withColumn("content_hash", F.nullif("content_hash", F.lit(""))), hashes, "id", keep=["content_hash"])


def materialize(tables: dict[str, DataFrame], outputs: DataFrame, tiebreak: Callable[[DataFrame], DataFrame] | None = None, at: Column | None = None) -> dict[str, DataFrame]:
    """The tables after the latest answers (article_id, probe, output) were written into them.

    Projects are resolved by article; roles are inserted where their key is new, their firms and the
    speakers of quotes going through the log of mentions; claims and quotes of the articles are replaced.
    """
    out = dict(tables)
    made = {name: written(df) for name, df in probes.materialize(outputs).items()}
    heads = made["projects"].withColumn("id", F.col("article_id")).withColumn("source", F.lit("corpus")).withColumn("source_type", F.lit("article")).withColumn("source_ref", F.col("article_id").cast("string"))
    heads = contracts.conform(heads, "projects").join(heads.select("id", "source_type", "source_ref"), "id")
    done = projects.resolve_projects(heads, tables["projects"], tables["project_sources"].select("project_id", "source_type", "source_ref", "confidence", "first_seen", "last_seen"), tiebreak, at)
    decided = written(done["decisions"].withColumnRenamed("id", "article_id"))
    new = decided.where("created").select(F.col("project_id").alias("id"), F.col("article_id").alias("source_article_id"))
    out["projects"] = upsert.fill_nulls(done["projects"], new, "id", keep=["source_article_id"])
    out["project_sources"] = done["sources"]
    of = decided.select("article_id", "project_id")
    # firms: of roles and of speakers, in order of article
    named = made["roles"].join(of, "article_id").select("article_id", F.lit(0).alias("kind"), F.col("firm").alias("name"))
    spoken = made["quotes"].where("trim(speaker_firm) <> ''").select("article_id", F.lit(1).alias("kind"), F.col("speaker_firm").alias("name"))
    start = lambda t: tables[t].agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] if t in tables else 0
    mentioned = written(upsert.with_ids(named.unionByName(spoken), ["article_id", "kind", "name"], start("firm_mentions")))
    firms, log = mentions.ingest(mentioned.select("id", "name"), tables["firms"])
    out["firms"], log = written(firms), written(log)
    firm_of = log.groupBy("name").agg(F.min_by("canonical_id", "id").alias("firm_id"))
    out["firm_mentions"] = _appended(tables, "firm_mentions", log.withColumnRenamed("name", "raw_text"))
    roles = made["roles"].join(of, "article_id").join(firm_of.withColumnRenamed("name", "firm"), "firm")
    roles = roles.select("project_id", "firm_id", "role", "team", F.col("firm").alias("raw_name"), "scope")
    fresh = written(upsert.first_by_key(roles, ["project_id", "firm_id", "role", "team"], ["raw_name", "scope"]).join(tables["roles"].select("project_id", "firm_id", "role", "team"), ["project_id", "firm_id", "role", "team"], "left_anti"))
    out["roles"] = _appended(tables, "roles", upsert.with_ids(fresh, ["project_id", "firm_id", "role", "team"], start("roles")))
    # people
    speakers = made["quotes"].where("trim(speaker_name) <> ''").select("article_id", "pos", F.col("speaker_name").alias("name"), F.col("speaker_title").alias("title"), "speaker_firm")
    speakers = speakers.join(firm_of.withColumnRenamed("name", "speaker_firm"), "speaker_firm", "left")
    people_said = written(upsert.with_ids(speakers, ["article_id", "pos"], start("person_mentions")))
    people, person_log = mentions.ingest(people_said.select("id", "name", "title", "firm_id"), tables["people"], "person")
    out["people"], person_log = written(people), written(person_log)
    logged = people_said.join(person_log.select("id", "canonical_id", "confidence", "corrected"), "id")
    out["person_mentions"] = _appended(tables, "person_mentions", logged.select("id", F.col("name").alias("raw_name"), F.col("title").alias("raw_title"), F.col("speaker_firm").alias("raw_firm"), "canonical_id", "confidence", "corrected"))
    # children of the articles
    touched = outputs.select("article_id").distinct()
    claims = made["claims"].join(of, "article_id", "left")
    claims = upsert.first_by_key(claims, ["project_id", "article_id", "text"], ["pos"], nulls_distinct=True)
    kept = lambda t: tables[t].join(touched, "article_id", "left_anti")
    out["claims"] = kept("claims").unionByName(contracts.conform(upsert.with_ids(claims, ["article_id", "pos"], start("claims")), "claims"), allowMissingColumns=True)
    quotes = made["quotes"].join(of, "article_id", "left").join(logged.select("article_id", "pos", F.col("canonical_id").alias("speaker_person_id")), ["article_id", "pos"], "left")
    quotes = upsert.first_by_key(quotes, ["project_id", "article_id", "text", "speaker_name"], ["pos"], nulls_distinct=True)
    out["quotes"] = kept("quotes").unionByName(contracts.conform(upsert.with_ids(quotes, ["article_id", "pos"], start("quotes")), "quotes"), allowMissingColumns=True)
    # the articles themselves
    said = made["articles"].join(of, "article_id", "full").select(F.col("article_id").alias("id"), F.col("project_id").alias("_project"), F.col("summary").alias("_summary"), F.col("author").alias("_author"), F.lit(True).alias("_done"))
    articles = tables["articles"].join(said, "id", "left")
    for c, new_value in (("primary_project_id", F.col("_project")), ("summary", F.col("_summary")), ("author", F.coalesce("_author", "author"))):
        articles = articles.withColumn(c, F.when(F.col("_done"), new_value).otherwise(F.col(c)))
    out["articles"] = articles.select(*tables["articles"].columns)
    out["article_projects"] = upsert.upsert_flag(tables["article_projects"], of.where("project_id is not null"), ["article_id", "project_id"], "is_primary")
    return out


def _appended(tables: dict[str, DataFrame], name: str, rows: DataFrame) -> DataFrame:
    rows = contracts.conform(rows, name)
    return tables[name].unionByName(rows) if name in tables else rows


def ingest(tables: dict[str, DataFrame], pages: DataFrame, segmenter: Callable[[str], str], prober: Callable[[str], str], force: bool = False, at: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """pages: filename, page, text.  The tables after the issues of the pages were taken in, and stats: outcome, n.

    A new issue is segmented and probed; one without articles is resumed; one with articles is skipped, or
    with ``force`` probed again without loss.
    """
    out = dict(tables)
    now = F.current_timestamp() if at is None else at
    states = written(probes.issue_state(tables["issues"], tables["articles"], pages.select("filename").distinct(), force))
    start = tables["issues"].agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = upsert.with_ids(states.where("state = 'fresh'").select("filename"), ["filename"], start)
    sizes = pages.groupBy("filename").agg(F.max("page").cast("int").alias("page_count"))
    fresh = fresh.join(sizes, "filename").select("id", "filename", issue_year("filename").alias("year"), issue_month("filename").alias("month_label"), "page_count", now.alias("ingested_at"))
    issues = written(tables["issues"].unionByName(contracts.conform(fresh, "issues")))
    numbered = pages.join(issues.select("filename", F.col("id").alias("issue_id")), "filename").join(states.select("filename", "state"), "filename")
    made = written(new_articles(numbered.where("state in ('fresh', 'resume')").select("issue_id", "page", "text"), tables["articles"], segmenter))
    if force:
        again = states.where("state = 'reprocess'").select("filename")
        old, rest = issues.join(again, "filename", "left_semi"), issues.join(again, "filename", "left_anti")
        old, articles = reprocess(old, tables["articles"], numbered.where("state = 'reprocess'").select("issue_id", "page", "text"))
        issues, articles = written(rest.unionByName(old)), written(articles)
    else:
        articles = tables["articles"]
    out["issues"] = issues
    out["articles"] = written(articles.unionByName(contracts.conform(made.withColumn("ingested_at", now), "articles")))
    live = numbered.where("state <> 'skip'").select("issue_id", "page", "text")
    inside = out["articles"].select("id", "issue_id", "title", "article_type", "page_start", "page_end", "content_hash").join(live, "issue_id").where("page between page_start and page_end")
    asked = inside.groupBy("id", "title", "article_type", "page_start", "content_hash").agg(F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))).alias("p")).withColumn("pages", F.transform("p", lambda x: x["text"])).drop("p")
    runs, stats = probes.run_probes(tables["probes"], written(asked), tables["probe_runs"], prober, at=at)
    out["probe_runs"] = written(contracts.conform(runs, "probe_runs"))
    latest = out["probe_runs"].join(tables["probes"].select(F.col("id").alias("probe_id"), F.col("name").alias("probe")), "probe_id").join(asked.select(F.col("id").alias("article_id")), "article_id", "left_semi")
    latest = probes.latest(latest, ["article_id", "probe"], output="output_json").withColumnRenamed("output_json", "output")
    return materialize(out, written(latest), at=at), stats


def rehearse(stages: list[tuple[str, Callable[[], object]]], gate: Callable[[dict], bool] | None = None, tolerated: tuple[str, ...] = ()) -> dict[str, object]:
    """Runs named stages in order: results by name.  After the first, ``gate`` may stop the rest; a tolerated stage's failure is its result, any other raises."""
    done: dict[str, object] = {}
    for k, (name, stage) in enumerate(stages):
        try:
            done[name] = stage()
        except Exception as e:  # noqa: BLE001  sweeps are idempotent and can run again
            if name not in tolerated:
                raise
            done[name] = e
        if k == 0 and gate and not gate(done):
            break
    return done


