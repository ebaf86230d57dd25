"""The entity tables: types, natural keys, references, and a check of a table against them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMAS = {
    "issues": "id long, filename string, year int, month_label string, page_count int, ingested_at timestamp",
    "articles": "id long, issue_id long, page_start int, page_end int, title string, author string, article_type string, summary string, primary_project_id long, content_hash string, embedding array<float>, ingested_at timestamp, search_tokens array<string>",
    "projects": "id long, name string, typology string, location string, city string, state string, county string, lat double, lng double, cost string, cost_usd long, estimated_cost_usd long, square_footage string, sq_ft int, stories_levels string, delivery_method string, year_completed int, status string, phase string, source string, source_article_id long, embedding array<float>",
    "article_projects": "article_id long, project_id long, is_primary boolean",
    "firms": "id long, name string, aliases array<string>, firm_type string, firm_type_aux array<string>, website string, notes string, embedding array<float>",
    "people": "id long, name string, title string, firm_id long, aliases array<string>, confidence float, notes string",
    "project_sources": "id long, project_id long, source_type string, source_ref string, confidence float, first_seen timestamp, last_seen timestamp",
    "roles": "id long, project_id long, firm_id long, role string, team string, raw_name string, confidence float, scope string",
    "claims": "id long, article_id long, project_id long, text string, type string, page int, confidence float, embedding array<float>, search_tokens array<string>",
    "quotes": "id long, article_id long, project_id long, speaker_name string, speaker_title string, speaker_firm string, speaker_person_id long, text string, page int, embedding array<float>, search_tokens array<string>",
    "probes": "id long, name string, version int, prompt string, schema_json string, model string, active boolean",
    "probe_runs": "id long, probe_id long, article_id long, probe_version int, model string, content_hash string, output_json string, ran_at timestamp",
    "firm_mentions": "id long, raw_text string, canonical_id long, confidence float, corrected boolean",
    "person_mentions": "id long, raw_name string, raw_title string, raw_firm string, canonical_id long, confidence float, corrected boolean",
}
#: Natural keys; in those marked True a null never equals another null.
NATURAL_KEYS = {
    "issues": (["filename"], True), "article_projects": (["article_id", "project_id"], True), "firms": (["name"], True), "people": (["name", "firm_id"], False), "project_sources": (["project_id", "source_type", "source_ref"], True),
    "roles": (["project_id", "firm_id", "role", "team"], True), "claims": (["project_id", "article_id", "text"], True), "quotes": (["project_id", "article_id", "text", "speaker_name"], True), "probes": (["name", "version"], True),
    "probe_runs": (["probe_id", "article_id", "probe_version", "content_hash"], False),
}
#: table, column, parent, whether the child goes with the parent.
REFERENCES = (
    ("articles", "issue_id", "issues", True), ("projects", "source_article_id", "articles", False), ("articles", "primary_project_id", "projects", False), ("article_projects", "article_id", "articles", True), ("article_projects", "project_id", "projects", True),
    ("people", "firm_id", "firms", False), ("project_sources", "project_id", "projects", True), ("roles", "project_id", "projects", True), ("roles", "firm_id", "firms", True), ("claims", "article_id", "articles", True), ("claims", "project_id", "projects", False),
    ("quotes", "article_id", "articles", True), ("quotes", "project_id", "projects", False), ("quotes", "speaker_person_id", "people", False), ("probe_runs", "probe_id", "probes", False), ("probe_runs", "article_id", "articles", True),
    ("firm_mentions", "canonical_id", "firms", False), ("person_mentions", "canonical_id", "people", False),
)


def schema(table: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order: missing ones null, others cast; an added column is dropped."""
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema(table)))


def assert_contract(df: DataFrame, table: str) -> None:
    """Raises ValueError where a column is missing or of another type."""
    have = dict(df.dtypes)
    bad = [f"{f.name} {f.dataType.simpleString()}" for f in schema(table) if have.get(f.name) != f.dataType.simpleString()]
    if bad:
        raise ValueError(f"{table} lacks {', '.join(bad)}")


def references(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REFERENCES), "table_name string, column_name string, parent string, cascades boolean")


def cascade_delete(tables: dict[str, DataFrame], table: str, ids: DataFrame) -> dict[str, DataFrame]:
    """The tables without rows of the ids (id) and, where references cascade, without their children; other references become null."""
    out = dict(tables)
    out[table] = out[table].join(ids, "id", "left_anti")
    for child, column, parent, cascades in REFERENCES:
        if parent != table or child not in out or child == table:
            continue
        hit = ids.select(F.col("id").alias(column))
        if cascades:
            gone = out[child].join(hit, column, "left_semi")
            if "id" in gone.columns:
                out = cascade_delete(out, child, gone.select("id"))
            else:
                out[child] = out[child].join(hit, column, "left_anti")
        else:
            marked = out[child].join(hit.withColumn("_hit", F.lit(True)), column, "left")
            out[child] = marked.withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*out[child].columns)
    return out
