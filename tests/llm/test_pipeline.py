"""The pipeline's stages on the smallest tables: each decision holds against a plain version."""

from __future__ import annotations

import numpy as np
import pytest

pytest.importorskip("tessera.llm.catalog")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import shingles, toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, the input first."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for _, f in corpus_pipeline.STAGES:
        kept = f(spark, docs, FOLDER)
        docs = spark.createDataFrame(kept.collect(), kept.schema)
        out.append(docs.collect())
    return out


def sets(rows):
    return [shingles.shingle_set(w) for w in shingles.word_prints([(r["text"] or "").encode() for r in rows])]


def test_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]
    columns = set(stages[0][0].asDict())
    assert all(set(rows[0].asDict()) == columns for rows in stages[1:5]) and set(stages[5][0].asDict()) == columns | {"size", "shard", "slot"}


def test_toxic_documents_go(spark, stages):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, toxicity.fit_model(docs, labels)).collect()}
    assert {r["doc_id"] for r in stages[1]} == {i for i, s in scores.items() if s < 0.5}


def test_one_of_each_class_stays(stages):
    before, kept = sets(stages[1]), sets(stages[2])
    linked = lambda a, b: len(a) and len(b) and 100 * (both := len(np.intersect1d(a, b))) >= 80 * (len(a) + len(b) - both)
    assert not any(linked(a, b) for k, a in enumerate(kept) for b in kept[:k])
    ids = {r["doc_id"] for r in stages[2]}
    for r, a in zip(stages[1], before, strict=True):  # what went is in a class with one that stayed
        assert r["doc_id"] in ids or any(linked(a, b) for x, b in zip(stages[1], before, strict=True) if x["doc_id"] != r["doc_id"])


def test_contaminated_documents_go(spark, stages):
    items = [s for s in sets(spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()) if len(s)]
    ids = {r["doc_id"] for r in stages[3]}
    for r, s in zip(stages[2], sets(stages[2]), strict=True):
        cover = max((np.isin(i, s).mean() for i in items), default=0)
        assert cover < 0.9 or r["doc_id"] not in ids
        assert cover > 0.1 or r["doc_id"] in ids


def test_mixing_keeps_all_and_shards_hold_all(stages):
    assert {r["doc_id"] for r in stages[4]} == {r["doc_id"] for r in stages[3]}
    assert sorted((r["doc_id"], r["text"]) for r in stages[5]) == sorted((r["doc_id"], r["text"]) for r in stages[4])
    slots = {}
    for r in stages[5]:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() == len(stages[5]) and out.agg(F.countDistinct("doc_id")).first()[0] == len({r["doc_id"] for r in stages[5]})
