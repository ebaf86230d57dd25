"""Every registered query and every stage of the pipeline over tables with nulls, ties, repeats, clashing columns and long texts, and over empty ones."""

from __future__ import annotations

import collections
import hashlib
import zlib

import numpy as np
import pytest

catalog = pytest.importorskip("tessera.llm.catalog")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

import test_llm_operators as plain  # noqa: E402
from tessera.llm import decontamination, secrets, sharding, toxicity  # noqa: E402

QUERIES = catalog.QUERIES
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, shard int, mix string, score string, spans string, item_id string, _hash string, id string"
LABELS, ITEMS, PAGES = "doc_id long, quality int, toxic int, text string", "item_id long, text string, doc_id string", "page_id long, url string, html string, host string, text string, score string"
PROSE = [plain.sentence(np.random.default_rng(90 + k), 60) + "." for k in range(4)]


def documents():
    r = np.random.default_rng(8)
    texts = [t for _, t, *_ in plain.rows()] + PROSE[:2] + [PROSE[2] + " and " + plain.sentence(r, 300), plain.sentence(r, 200) + " " + PROSE[3].upper(), "password = 'x9fKq2vLzzzz' mail a.b@c.de 1.2.3.4", "you vile oaf. " * 3, "é" * 3000 + " 4111111111111111"]
    rows = [(k, t, None if k % 7 == 0 else "en", [None, "a", "b", "hot", "hot"][k % 5], None, 5, "m", "sc", "sp", "it", "h", "i") for k, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, "no id", *rows[0][2:]), (None, None, *rows[0][2:])]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hostile"))
    rows = documents()
    write = lambda some, kind, name: spark.createDataFrame(some, kind).repartition(3).write.parquet(f"{path}/{name}.parquet")
    write(rows, DOCUMENTS, "documents")
    write([(r[0], None, int("vile" in (r[1] or "")) if k % 6 else None, "t") for k, r in enumerate(rows)] + [(None, 1, 1, None), (10**9, 0, 1, None)], LABELS, "labels")
    write([*((k, t, "d") for k, t in enumerate(PROSE)), (8, PROSE[0], "d"), (9, None, None), (10, " ", "d"), (None, PROSE[1], None)], ITEMS, "benchmark")
    words = "A paragraph with enough words to read, and more of them."
    pages = [(0, "http://casino.example.com/en/1", f"<article><p>{words}</p></article>"), (1, "https://a.example.net/de/8", None), (2, None, "<p>x"), (3, "no scheme", ""), (4, "http://example.com/en/7?x", "<" * 500), (None, "http://x/" + "y" * 20_000, f"<p>{words * 500}</p>"), (0, "http://casino.example.com/en/1", f"<article><p>{words}</p></article>")]
    write([(*p, "h", "t", "s") for p in pages], PAGES, "pages")
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name, kind in (("documents", DOCUMENTS), ("labels", LABELS), ("benchmark", ITEMS), ("pages", PAGES)):
        spark.createDataFrame([], kind).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_nothing(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def query(spark, folder, start):
    (f,) = (f for n, f in QUERIES.items() if n.startswith(start + "_"))
    return f(spark, folder).collect()


def ids(rows, column="doc_id"):
    return collections.Counter(r[column] for r in rows)


EVERY = collections.Counter(r[0] for r in documents())
TEXT = {r[0]: r[1] for r in documents()}


def shown(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))


def test_shards_are_of_the_least_capacity(spark, folder):
    got = query(spark, folder, "op1")
    assert ids(got) == EVERY and {r["law"] for r in got} == {"bytes"}
    sizes, slots, homes = collections.Counter(), collections.defaultdict(list), {}
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert homes.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]
        if r["doc_id"] is not None:
            text = (TEXT[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    t = spark.read.parquet(f"{folder}/documents.parquet").select(F.coalesce("text", F.lit("")).alias("t"))
    groups = t.groupBy(F.xxhash64("t").alias("h")).agg(F.sum(F.octet_length("t") + 16).alias("s")).orderBy("h").collect()
    assert max(sizes.values()) <= plain.minimax([g["s"] for g in groups], sharding.SHARDS)


def test_copies(spark, folder):
    got, groups = query(spark, folder, "op2"), collections.defaultdict(list)
    for r in documents():
        groups[hashlib.sha256((r[1] or "").encode()).hexdigest()].append(r[0])
    assert ids(got) == EVERY
    for r in got:
        own = groups[r["text_sha256"]]
        stays = max((x for x in own if x is not None), default=None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (stays, len(own), r["doc_id"] == stays)


def test_mixing_uses_every_document(spark, folder):
    got = query(spark, folder, "op3")
    assert collections.Counter(r["doc_id"] for r in got if r["use"] == 0) == EVERY
    assert sum({r["source"]: r["weight"] for r in got}.values()) == pytest.approx(1)


def test_personal_data(spark, folder):
    got = query(spark, folder, "op4")
    assert ids(got) == EVERY
    for r in got:
        if r["doc_id"] is not None:
            text = TEXT[r["doc_id"]] or ""
            want = [(m.start(), n, m.end(), kind) for n, (kind, p) in enumerate(plain.PLAIN.items()) for m in p.finditer(text) if plain.fine(kind, m.group())]
            assert [r[f"n_{k}"] for k in plain.PLAIN] == [sum(w[3] == k for w in want) for k in plain.PLAIN]
            assert r["base_sha256"] == hashlib.sha256(shown(want).encode()).hexdigest() and {x for x in shown(want).split(",") if x} <= set(r["spans"].split(","))


def test_near_copies(spark, folder):
    got = query(spark, folder, "op5")
    want = collections.Counter((i, n, c) for i, n, c in plain.classes_of([(r[0], r[1]) for r in documents()]) if i is not None)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == want and ids(got) == EVERY


def test_leaks(spark, folder):
    got = {(r["doc_id"], r["item_id"]) for r in query(spark, folder, "op6")}
    items = {**dict(enumerate(PROSE)), 8: PROSE[0], None: PROSE[1]}
    want = set()
    for doc, text in TEXT.items():
        words = (text or "").lower().split()
        for item, own in items.items():
            own = own.lower().split()
            if len(words) < 5_000 and plain.longest_common(own, words) >= decontamination.ALONE * len(own):
                want.add((doc, item))
    assert want == got and len(want) >= 6


def test_url_rules(spark, folder):
    got = query(spark, folder, "op7")
    assert ids(got, "page_id") == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1, None: 1}
    urls = {0: "http://casino.example.com/en/1", 1: "https://a.example.net/de/8", 2: None, 3: "no scheme", 4: "http://example.com/en/7?x", None: "http://x/" + "y" * 20_000}
    for r in got:
        host, path = plain.plain_parts(urls[r["page_id"]])
        rule = plain.plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0]) and (r["verdict"] == rule[1] if rule else r["verdict"] in ("allow", "block"))


def test_main_texts(spark, folder):
    got = query(spark, folder, "op8")
    words = "A paragraph with enough words to read, and more of them."
    texts = {r["page_id"]: r["text"] for r in got}
    assert ids(got, "page_id") == {0: 2, 1: 1, 2: 1, 3: 1, 4: 1, None: 1} and all(r["n_chars"] == len(r["text"]) for r in got)
    assert texts[0] == words and texts[1] == texts[3] == "" and texts[None] == words * 500


def test_secrets(spark, folder):
    got = query(spark, folder, "op9")
    assert ids(got) == EVERY
    for r in got:
        if r["doc_id"] is not None:
            want = []
            for n, (kind, p) in enumerate(plain.SECRET.items()):
                for m in p.finditer(TEXT[r["doc_id"]] or ""):
                    if len(m.group(2) if kind == "assign" else m.group()) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                        want.append((m.start(), n, m.end(), kind))
            assert [r[f"n_{k}"] for k in secrets.BASE] == [sum(w[3] == k for w in want) for k in secrets.BASE]
            assert r["base_sha256"] == hashlib.sha256(shown(want).encode()).hexdigest()


def test_toxicity(spark, folder):
    got = query(spark, folder, "op10")
    assert ids(got) == EVERY
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_noisy_or_against_a_plain_one():
    texts = [b"Vile oaf! A fine day.", b"", b"...", b"one two. two one. one one", b"x" * 50_000 + b". end"]
    r = np.random.default_rng(1)
    weights = r.normal(0, 1, toxicity.WIDTH).astype(np.float32)
    weights[0] = 0
    bags = toxicity.Bags(texts)
    got = toxicity.scores(bags, bags.logits(weights, -1.0))
    for k, text in enumerate(texts):
        left = 1.0
        for part in text.replace(b"!", b".").replace(b"?", b".").split(b"."):
            if part.split():
                alone = toxicity.Bags([part])  # one sentence
                left *= 1 - 1 / (1 + np.exp(-(weights[alone.features].sum() - 1.0)))
        assert got[k] == pytest.approx(1 - left, abs=1e-6)


# ---- the pipeline


def test_stages_keep_their_columns_on_hostile_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = collections.Counter(r["doc_id"] for r in docs.collect())
        out = stage(spark, docs, folder)
        docs = spark.createDataFrame(out.collect(), out.schema)
        after = collections.Counter(r["doc_id"] for r in docs.collect())
        if k < 4:
            assert docs.columns == columns, name
        if name in ("toxicity", "near duplicates", "decontamination"):
            assert not after - before
        elif name == "mixing":
            assert set(after) == set(before) and not before - after
        else:
            assert after == before and {"size", "shard", "slot"} <= set(docs.columns)
        assert after[None] == before[None] or name == "mixing"  # rows without an id are clean here, and nobody's copies
        if name == "near duplicates":
            assert max(n for i, n in after.items() if i is not None) == 1


def test_stages_on_empty_tables(spark, empty):
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, empty).count() == 0
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    for path in ("/root/testdata/sf0.001", folder):
        con = duckdb.connect()
        rows = f"'{path}/documents.parquet'" if path != folder else f"'{path}/documents.parquet/*.parquet'"
        con.sql(f"CREATE VIEW documents AS SELECT * FROM {rows}" + ("" if path != folder else " WHERE doc_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id) = 1"))
        want = con.sql(catalog.ORACLE_SQL[name]).df()
        got = QUERIES[name](spark, path).toPandas()[list(want.columns)]
        if path == folder:  # ids that repeat, or are null, are beside the SQL
            got, want = (x[["doc_id", *[c for c in x.columns if c in ("n_shingles", "text_sha256")]]].dropna().drop_duplicates() for x in (got, want))
        plain_rows = lambda x: sorted(tuple(str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in x.itertuples(index=False, name=None))
        assert plain_rows(got) == plain_rows(want)
