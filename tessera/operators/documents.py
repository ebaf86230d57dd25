"""Context documents of projects, articles, claims, quotes and firms, ready to embed."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import joined_parts, truncate_words

#: Longest texts by table.
CAPS = {"project": 3000, "article": 2400, "claim": 600, "quote": 800, "firm": 800}


def longest(rows: DataFrame, key: str, text: str, id_col: str, n: int) -> DataFrame:
    """The n longest texts of each key; ties go to the smaller id."""
    order = Window.partitionBy(key).orderBy(F.desc(F.length(text)), id_col)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def joined_longest(rows: DataFrame, key: str, text: str, id_col: str, n: int, sep: str = " | ") -> DataFrame:
    """key, context: the n longest texts, longest first."""
    top = longest(rows, key, text, id_col, n).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("rank", text))).alias("_t"))
    return top.select(key, F.array_join(F.transform("_t", lambda x: x[text]), sep).alias("context"))


def context(kind: str, *parts: Column | str) -> Column:
    return truncate_words(joined_parts(*parts), CAPS[kind])


def is_noise(article_type: str, summary: str) -> Column:
    """Articles that carry no information."""
    s = F.coalesce(F.col(summary), F.lit(""))
    return ~(F.col(article_type).isNull() | (F.col(article_type) == "project_feature")) | s.ilike("%pages do not contain%") | s.ilike("%no information about%")


def hashed_trigrams(texts: pd.Series, width: int = 64) -> pd.Series:
    """The default embedder: counts of hashed trigrams, offline and the same everywhere."""
    import zlib

    def one(t: str) -> list[float]:
        v = [0.0] * width
        for k in range(len(t) - 2):
            v[zlib.crc32(t[k : k + 3].encode()) % width] += 1.0
        return v

    return texts.fillna("").map(one)


def embed_missing(rows: DataFrame, text: Column, embedder: Callable[[pd.Series], pd.Series] = hashed_trigrams, redo: bool = False) -> DataFrame:
    """Rows with ``embedding`` filled where it is null (everywhere with redo) and there is a text."""

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield embedder(texts)

    wanted = (F.lit(True) if redo else F.col("embedding").isNull()) & (F.coalesce(text, F.lit("")) != "")
    todo = rows.withColumn("_text", F.when(wanted, text))
    some = todo.where("_text is not null").withColumn("embedding", run("_text"))
    return some.unionByName(todo.where("_text is null")).drop("_text")


def _with(prefix: str, c: str, ok: Column | None = None) -> Column:
    """The prefix and the value, or null without a value."""
    value = F.col(c).cast("string")
    return F.when((value != "") & (F.lit(True) if ok is None else ok), F.concat(F.lit(prefix), value))


def project_text() -> Column:
    where = joined_parts("city", "state", "county", sep=" ")
    return context("project", "name", "typology", where, "location", "status", _with("Year completed ", "year_completed"), _with("Cost ", "cost"), "article_summaries", "top_claims", "top_quotes", _with("Team: ", "firms"))


def article_text() -> Column:
    return context("article", "title", _with("By ", "author"), "summary", _with("Project: ", "project_names"), "top_claims", "top_quotes")


def claim_text() -> Column:
    head = joined_parts("project_name", "type", sep=", ")
    prefix = F.when(head != "", F.concat(F.lit("["), head, F.lit("] "))).otherwise("")
    return truncate_words(F.trim(F.concat(prefix, F.coalesce("text", F.lit("")))), CAPS["claim"])


def quote_text() -> Column:
    speaker = joined_parts("speaker_name", "speaker_title", _with("at ", "speaker_firm"), sep=", ")
    head = F.when(speaker != "", F.concat(F.lit(" — "), speaker)).otherwise("")
    tail = F.coalesce(F.concat(F.lit(" (project: "), F.nullif(F.col("project_name"), F.lit("")), F.lit(")")), F.lit(""))
    return truncate_words(F.concat(F.trim(F.coalesce("text", F.lit(""))), head, tail), CAPS["quote"])


def firm_text() -> Column:
    aliases = F.array_join("aliases", ", ")
    return context("firm", "name", _with("Type: ", "firm_type", F.col("firm_type") != "unknown"), F.when(aliases != "", F.concat(F.lit("Also known as: "), aliases)), _with("Roles: ", "roles_played"))


def _tops(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    return joined_longest(rows.where(F.col(key).isNotNull() & F.col("text").isNotNull()), key, "text", "id", n).select(F.col(key).alias("id"), F.col("context").alias(name))


def texts_of(table: str, tables: dict[str, DataFrame]) -> DataFrame:
    """id, _document: what a row of projects, articles, claims, quotes or firms says, with what hangs on it; articles without information have none."""
    named = tables["projects"].select(F.col("id").alias("project_id"), F.col("name").alias("project_name"))
    if table == "claims":
        return tables["claims"].join(named, "project_id", "left").select("id", claim_text().alias("_document"))
    if table == "quotes":
        return tables["quotes"].join(named, "project_id", "left").select("id", quote_text().alias("_document"))
    firm_roles = tables["roles"].join(tables["firms"].select(F.col("id").alias("firm_id"), F.col("name").alias("firm")), "firm_id")
    if table == "firms":
        played = tables["roles"].where("role is not null").groupBy(F.col("firm_id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("role")), ", ").alias("roles_played"))
        return tables["firms"].join(played, "id", "left").select("id", firm_text().alias("_document"))
    if table == "projects":
        said = tables["article_projects"].join(tables["articles"].select(F.col("id").alias("article_id"), "summary"), "article_id").where("summary is not null")
        said = said.groupBy(F.col("project_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("article_id", "summary"))).alias("s")).select("id", F.array_join(F.transform("s", lambda x: x["summary"]), " | ").alias("article_summaries"))
        firms = firm_roles.groupBy(F.col("project_id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("firm")), ", ").alias("firms"))
        out = tables["projects"].join(said, "id", "left").join(_tops(tables["claims"], "project_id", 8, "top_claims"), "id", "left").join(_tops(tables["quotes"], "project_id", 4, "top_quotes"), "id", "left").join(firms, "id", "left")
        return out.select("id", project_text().alias("_document"))
    kept = tables["articles"].where(~is_noise("article_type", "summary"))
    names = tables["article_projects"].join(named, "project_id").where("project_name is not null").groupBy(F.col("article_id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("project_name")), ", ").alias("project_names"))
    out = kept.join(names, "id", "left").join(_tops(tables["claims"], "article_id", 5, "top_claims"), "id", "left").join(_tops(tables["quotes"], "article_id", 4, "top_quotes"), "id", "left")
    return out.select("id", article_text().alias("_document"))
