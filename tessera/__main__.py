"""Sweeps and reports over a folder of entity tables: ``python -m tessera COMMAND --tables FOLDER``.

Every command reads the last version of each table, prints its figures as JSON lines and, where it
changes a table, writes a new version.  External services are given as ``module:function``; without one a
command does what needs none.
"""

from __future__ import annotations

import argparse
import importlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import classify, consolidate, documents, geocode, ingest, mentions, probes
from tessera.sources import links, signals, sinks, tables
from tessera.sources.store import Store


def _service(name: str | None) -> Callable | None:
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _show(rows: DataFrame, limit: int | None = None) -> None:
    """A JSON line for each row: figures, or planned changes."""
    for line in (rows.limit(limit) if limit else rows).toJSON().toLocalIterator():
        print(line)


def _files(store: Store, folder: str) -> DataFrame:
    """Pages as Parquet or JSON lines: filename, page, text (or page_id, html)."""
    reader = store.spark.read
    return reader.json(folder) if folder.rstrip("/").endswith(("json", "jsonl")) else reader.parquet(folder)


def harvest(store: Store, a: argparse.Namespace) -> None:
    _show(links.harvest(_files(store, a.pages), base=a.base, suffix=a.suffix))


def score_pages(store: Store, a: argparse.Namespace) -> None:
    _show(signals.score_pages(_files(store, a.pages), a.threshold).drop("text"))


def take_in(store: Store, a: argparse.Namespace) -> None:
    pages = _files(store, a.pages)
    if a.limit:
        pages = pages.join(pages.select("filename").distinct().orderBy("filename").limit(a.limit), "filename", "left_semi")
    out, stats = ingest.ingest(store.all(), pages, _service(a.segmenter), _service(a.prober), a.reprocess)
    for name, df in out.items():
        store.write(name, df)
    _show(stats)


def resolve_mentions(store: Store, a: argparse.Namespace) -> None:
    kind, table, log, raw = ("person", "people", "person_mentions", "raw_name") if a.command == "resolve-people" else ("firm", "firms", "firm_mentions", "raw_text")
    rows = store.read(log)
    named = rows.withColumnRenamed(raw, "name")
    if kind == "person":
        named = mentions.firm_of(named, store.read("firms"))
    out = mentions.sweep(named, store.read(table), kind, _service(a.decide), a.redo, a.limit)
    store.write(table, out["entities"])
    store.write(log, out["log"].withColumnRenamed("name", raw))
    _show(out["stats"])


def consolidate_tables(store: Store, a: argparse.Namespace) -> None:
    """Without --apply the plan is shown and nothing is written."""
    if a.target == "roles":
        planned = consolidate.redundant_roles(store.read("roles"))
        _show(sinks.decision_stats(planned, "action"))
        if a.apply:
            store.write("roles", consolidate.apply_deletes(store.read("roles"), planned))
        return
    entity = "projects" if a.target == "projects" else "firms"
    rows = store.read(entity)
    same = _service(a.decide)
    if a.target == "firms":
        roots = consolidate.paren_clusters(rows.select("id", "name"))
    elif a.target == "firms-fuzzy":
        if same is None:
            raise SystemExit("firms-fuzzy needs --decide")
        roots = consolidate.similar_roots(rows.select("id", "name"), 0.55, 0.92, same)
    else:
        roots = consolidate.similar_roots(rows.select("id", "name"), 0.92)
    _show(roots.where("id <> root"))
    if not a.apply:
        return
    if entity == "firms":
        made = consolidate.merge_firms({t: store.read(t) for t in ("firms", "roles", "people", "quotes", "firm_mentions", "person_mentions")}, roots)
    else:
        children = {"article_projects": ["article_id", "project_id"], "project_sources": ["project_id", "source_type", "source_ref"], "roles": ["project_id", "firm_id", "role", "team"], "claims": ["project_id", "article_id", "text"], "quotes": ["project_id", "article_id", "text", "speaker_name"]}
        made = {"projects": consolidate.merge_entities(rows, roots, inherit=["source_article_id"])}
        for t, keys in children.items():
            order = ["id"] if "id" in tables.schema(t).names else ["is_primary"]
            made[t] = consolidate.merge_children(store.read(t), roots, "project_id", keys, order)
        made["articles"] = consolidate.repoint(store.read("articles"), roots, "primary_project_id").drop("_moved")
    for name, df in made.items():
        store.write(name, df)


def classify_firms(store: Store, a: argparse.Namespace) -> None:
    planned = classify.planned_types(store.read("firms"), store.read("roles"), a.only_unknown)
    _show(planned)
    if not a.dry_run:
        store.write("firms", classify.apply_types(store.read("firms"), planned))


def embed(store: Store, a: argparse.Namespace) -> None:
    embedder = _service(a.embedder) or documents.hashed_trigrams
    for name in a.names:
        text = documents.texts_of(name, store.all())
        rows = store.read(name)
        rows = rows.join(text, "id", "left")
        out = documents.embed_missing(rows, F.col("_document"), embedder, a.redo).drop("_document")
        store.write(name, out)
        print(json.dumps({"table": name, "embedded": out.where("embedding is not null").count()}))


def place(store: Store, a: argparse.Namespace) -> None:
    out, stats = geocode.sweep(store.read("projects"), _service(a.backend), a.redo, a.limit, a.dry_run, a.throttle_sec)
    if not a.dry_run:
        store.write("projects", out)
    _show(stats)


def seed_probes(store: Store, a: argparse.Namespace) -> None:
    known = store.read("probes")
    start = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = store.spark.createDataFrame([(start + k, p.name, p.version, p.prompt, p.schema, p.model, True) for k, p in enumerate(probes.REGISTRY, 1)], tables.schema("probes"))
    out = probes.register(known, new)
    print(json.dumps({"inserted": out.count() - known.count(), "unchanged": known.count()}))
    store.write("probes", out)


def workbook(store: Store, a: argparse.Namespace) -> None:
    projects = store.read("projects")
    roles = store.read("roles").join(store.read("firms").select(F.col("id").alias("firm_id"), F.col("name").alias("firm")), "firm_id")
    team = roles.join(projects.select(F.col("id").alias("project_id"), F.col("name").alias("project")), "project_id").select("project_id", "project", "team", "role", "firm")
    facts = projects.select("id", "name", "typology", "location", "city", "state", "cost", "square_footage", "stories_levels", "delivery_method", "year_completed", "status", "source")
    if a.output.endswith(".xlsx"):
        with open(a.output, "wb") as out:
            sinks.workbook({"Projects": facts, "Team": team}, out)
    else:
        sinks.workbook_tables(facts, team, a.output)
    _show(sinks.column_widths(facts))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera", description=__doc__)
    some = p.add_subparsers(dest="command", required=True)

    def add(name: str, run: Callable, **options: dict) -> None:
        c = some.add_parser(name)
        c.add_argument("--tables", required=True)
        for option, how in options.items():
            c.add_argument(f"--{option.replace('_', '-')}", **how)
        c.set_defaults(run=run)

    flag, number = {"action": "store_true"}, {"type": int}
    add("harvest", harvest, pages={"required": True}, base={"default": ""}, suffix={"default": ".pdf"})
    add("score-pages", score_pages, pages={"required": True}, threshold={"type": int, "default": signals.THRESHOLD})
    add("ingest", take_in, pages={"required": True}, segmenter={"required": True}, prober={"required": True}, reprocess=flag, limit=number)
    for name in ("resolve-firms", "resolve-people"):
        add(name, resolve_mentions, decide={}, limit=number, redo=flag)
    add("consolidate", consolidate_tables, target={"required": True, "choices": ["firms", "firms-fuzzy", "roles", "projects"]}, apply=flag, decide={})
    add("classify-firms", classify_firms, only_unknown=flag, dry_run=flag)
    add("embed", embed, names={"nargs": "+", "default": ["projects", "articles", "claims", "quotes", "firms"]}, embedder={}, redo=flag)
    add("geocode", place, backend={"required": True}, limit=number, redo=flag, dry_run=flag, throttle_sec={"type": float, "default": 0.05})
    add("seed-probes", seed_probes)
    add("workbook", workbook, output={"required": True})
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(Store(spark or SparkSession.builder.getOrCreate(), a.tables), a)


if __name__ == "__main__":
    main()
