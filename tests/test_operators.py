"""Resolution, merges, probes, sources and streams on small tables."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import classify, consolidate, documents, geocode, graph, ingest, mentions, probes, projects, resolve, similarity, upsert, vectors
from tessera.sources import links, readers, signals, sinks, tables
from tessera.streaming import incremental


def test_trigrams(spark):
    row = spark.range(1).select(similarity.similarity(similarity.trigrams(F.lit("word")), similarity.trigrams(F.lit("two words")))).first()
    assert row[0] == pytest.approx(4 / 11)


NAMES = st.lists(st.text(alphabet="abc é", min_size=0, max_size=12), min_size=1, max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NAMES, st.sampled_from([0.45, 0.55, 0.92]))
def test_similarity_join_is_exact(spark, names, floor):
    import re

    def grams(s):
        return {f"  {w} "[k : k + 3] for w in re.findall(r"[^\W_]+", s.lower()) for k in range(len(w) + 1)}

    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    got = {(r["left_id"], r["right_id"]) for r in similarity.similar_names(df, df, floor, same=True).collect()}
    sets = [grams(n) for n in names]
    want = {(a, b) for b in range(len(names)) for a in range(b) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= floor}
    assert got == want


def test_cascade(spark):
    firms = spark.createDataFrame([(1, "Acme Builders Inc", ["AB"]), (2, "Zenith Steel Works", []), (3, "acme builders", [])], "id long, name string, aliases array<string>")
    mentions = spark.createDataFrame([(1, "ACME BUILDERS"), (2, "Acme Builders, LLC"), (3, "ab"), (4, "Zenith Steel Work"), (5, "Nobody"), (6, "Zenith Stel Wrks"), (7, "LLC")], "id long, name string")
    got = {r["id"]: (r["match_id"], r["stage"]) for r in resolve.match_firms(mentions, firms, text.normalize_firm).collect()}
    assert got[1] == (3, "exact") and got[2] == (1, "normalized") and got[3] == (1, "alias") and got[5] == (None, "none") and got[7] == (None, "none")
    assert got[4][1] in ("trigram", "candidates") and got[6][1] in ("candidates", "none")


def test_people_stay_in_their_firm(spark):
    people = spark.createDataFrame([(1, "Jane Smith", 10, []), (2, "Jane Smith", None, [])], "id long, name string, firm_id long, aliases array<string>")
    mentions = spark.createDataFrame([(1, "jane smith", 10), (2, "Dr. Jane Smith", None), (3, "Jane Smith", 11), (4, "Mr", 10)], "id long, name string, firm_id long")
    got = {r["id"]: r["match_id"] for r in resolve.match_people(mentions, people, text.normalize_person).collect()}
    assert got == {1: 1, 2: 2, 3: None, 4: None}


def test_project_decisions(spark):
    rows = spark.createDataFrame([(1, 10, 0.97, 0.95), (1, 11, 0.5, 0.4), (2, 10, 0.97, 0.95), (2, 11, 0.96, 0.9), (3, 12, 1.0, 0.9), (4, 13, 0.5, 0.3)], "key long, candidate long, sim double, score double")
    got = {r["key"]: r["decision"] for r in projects.decide(rows).collect()}
    assert got == {1: "auto", 2: "tiebreak", 3: "tiebreak", 4: "create"}
    one = spark.range(1)
    score = lambda p, c, y: one.select(resolve.project_score(F.lit(1.0), F.lit(p), F.lit(c), F.lit(y))).first()[0]
    assert score(True, True, True) == pytest.approx(0.95) and score(True, True, None) == pytest.approx(0.9) and score(False, False, False) == pytest.approx(0.3)


def test_leaders(spark):
    rows = spark.createDataFrame([(1, "Northern Granite Partners of Nordia"), (2, "Northern Granite Partners of Nordias"), (3, "Something Else Entirely"), (4, "northern granite partners of nordia"), (5, "Something Else Entirely, Inc."), (6, None)], "id long, name string")
    assert {r["id"]: r["leader"] for r in mentions.leaders(rows, floor=0.85).collect()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 3}


def one_by_one(names, floor):
    """Leaders by a plain loop."""
    import re

    grams = lambda s: {f"  {w} "[k : k + 3] for w in re.findall(r"[^\W_]+", s.lower()) for k in range(len(w) + 1)}
    like = lambda a, b: len(grams(a) & grams(b)) / max(1, len(grams(a) | grams(b)))
    norm = lambda s: re.sub(r"(?: (?:llc|inc|co))+$", "", " " + " ".join(re.sub(r"[^\w\s&]", " ", s.lower()).split())).strip()
    heads, out = [], {}
    for i, n in names:
        best = min([(0, 0.0, h) for h, m in heads if m.lower() == n.lower()] + [(1, 0.0, h) for h, m in heads if norm(n) and norm(m) == norm(n)] + [(2, -like(m, n), h) for h, m in heads if like(m, n) >= floor], default=None)
        if best is None:
            heads.append((i, n))
        out[i] = best[2] if best else i
    return out


def test_leaders_as_one_by_one(spark):
    import random

    r = random.Random(5)
    forms = ["granite works", "granite work", "Granite Works LLC", "granite works, inc", "granite worksx", "steel & co", "steel", "Inc", "inc.", "basalt house", "basalt houses", "basalt housess"]
    names = [(k + 1, r.choice(forms)) for k in range(60)]
    got = {x["id"]: x["leader"] for x in mentions.leaders(spark.createDataFrame(names, "id long, name string"), floor=0.7).collect()}
    assert got == one_by_one(names, 0.7)


def test_a_large_group_of_like_names_has_one_leader(spark):
    base = "western mountain valley construction and engineering company of the northern territories number"
    names = [(k + 1, f"{base} {'x' * (k % 7)}" if k % 2 else base) for k in range(400)]
    got = mentions.leaders(spark.createDataFrame(names, "id long, name string"), floor=0.9)
    assert {r["leader"] for r in got.collect()} == {1}


def test_mentions_are_logged_and_swept(spark):
    firms = spark.createDataFrame([(1, "Acme Builders Inc", ["AB"])], "id long, name string, aliases array<string>")
    said = spark.createDataFrame([(1, "ACME BUILDERS"), (2, "Basalt House"), (3, "basalt house LLC"), (4, "ab"), (5, None)], "id long, name string")
    made, log = mentions.ingest(said, firms)
    assert {r["id"]: r["name"] for r in made.collect()} == {1: "Acme Builders Inc", 2: "Basalt House"}
    assert {r["id"]: (r["canonical_id"], r["confidence"]) for r in log.collect()} == {1: (1, 1.0), 2: (2, None), 3: (2, 1.0), 4: (1, 1.0)}
    open_ = spark.createDataFrame([(1, "Acme Builders", None, None, False), (2, "Basalt Hs", 2, None, False), (3, "New Firm", None, None, False), (4, "Odd", None, None, False), (5, "Kept", 1, 0.5, True), (6, "Unsaid", None, None, False)], "id long, name string, canonical_id long, confidence double, corrected boolean")

    def decide(rest):
        assert {r["raw"] for r in rest.collect()} == {"Basalt Hs", "New Firm", "Odd", "Unsaid"}
        return rest.sparkSession.createDataFrame([("Basalt Hs", "match", 2, None, 0.9), ("New Firm", "new", None, " New Firm Co ", 0.7), ("Odd", "match", 99, None, 0.9)], "raw string, decision string, canonical_id long, canonical_name string, confidence double")

    out = mentions.sweep(open_, made, decide=decide)
    assert {r["outcome"]: r["n"] for r in out["stats"].collect()} == {"resolved_deterministic": 1, "resolved_llm": 1, "created": 1, "skipped": 1, "ambiguous": 1}
    got = {r["id"]: (r["canonical_id"], r["confidence"]) for r in out["log"].collect()}
    assert got == {1: (1, 1.0), 2: (2, 0.9), 3: (3, 0.7), 4: (None, None), 5: (1, 0.5), 6: (None, None)}
    assert {r["name"]: sorted(r["aliases"]) for r in out["entities"].collect()} == {"Acme Builders Inc": ["AB", "Acme Builders"], "Basalt House": ["Basalt Hs"], "New Firm Co": ["New Firm"]}


def test_people_mentions(spark):
    people = spark.createDataFrame([(4, "Jane Smith", 10, [])], "id long, name string, firm_id long, aliases array<string>")
    said = spark.createDataFrame([(1, "Dr. Jane Smith", None, 10), (2, "Jane Smith", "Head", 11), (3, "jane smith", None, 11), (4, " ", None, 10), (5, "Mr", None, 10), (6, "Mr", None, 10)], "id long, name string, title string, firm_id long")
    made, log = mentions.ingest(said, people, "person")
    assert {r["id"]: (r["canonical_id"], r["confidence"]) for r in log.collect()} == {1: (4, 1.0), 2: (5, None), 3: (5, 1.0), 5: (6, None), 6: (6, None)}
    assert {(r["name"], r["firm_id"]) for r in made.collect()} == {("Jane Smith", 10), ("Jane Smith", 11), ("Mr", 10)}


def test_projects_are_resolved(spark):
    known = tables.conform(spark.createDataFrame([(1, "Harbour Tower", "Northport", 5_000_000, 2020), (2, "Harbour Tower North", "Southport", None, None), (3, "Other Place", None, None, None)], "id long, name string, city string, cost_usd long, year_completed int"), "projects")
    sources = spark.sql("SELECT 3L AS project_id, 'article' AS source_type, '77' AS source_ref, 0.5F AS confidence, timestamp'2024-01-01' AS first_seen, timestamp'2024-01-01' AS last_seen")
    rows = [(11, "Whatever", None, None, None, "article", "77"), (12, "harbour tower", "northport", 5_100_000, 2022, "article", "78"), (13, "Harbour Towers", "Southport", None, None, "article", "79"), (14, "Unseen Works", None, None, None, "article", "80"), (15, "Unseen Works again", None, None, None, "article", "80"), (16, "Loose", None, None, None, None, None)]
    asked = spark.createDataFrame(rows, "id long, name string, city string, cost_usd long, year_completed int, source_type string, source_ref string")
    asked = tables.conform(asked, "projects").join(asked.select("id", "source_type", "source_ref"), "id")
    out = projects.resolve_projects(asked, known, sources, tiebreak=lambda rest: rest.select("key", F.col("best")[0]["candidate"].alias("candidate"), F.lit(0.6).alias("confidence")))
    got = {r["id"]: (r["project_id"], r["created"], r["decision"]) for r in out["decisions"].collect()}
    assert got[11] == (3, False, "known") and got[12] == (1, False, "auto") and got[13][2] == "tiebreak"
    assert got[14] == (4, True, "create") and got[15] == (4, False, "create") and got[16] == (5, True, "create")
    assert {r["id"]: r["name"] for r in out["projects"].where("id > 3").collect()} == {4: "Unseen Works", 5: "Loose"}
    assert {(r["project_id"], r["source_ref"]) for r in out["sources"].collect()} == {(3, "77"), (1, "78"), (got[13][0], "79"), (4, "80")}


def test_merge_projects(spark):
    df = spark.createDataFrame
    made = {
        "projects": df([(1, "winner", None), (2, "loser", 20)], "id long, name string, source_article_id long"),
        "roles": df([(1, 1, 7, "architect", "design"), (2, 2, 7, "architect", "design"), (3, 2, 8, "engineer", "design")], "id long, project_id long, firm_id long, role string, team string"),
        "quotes": df([(1, 1, 5, "q", "Al"), (2, 2, 5, "q", "Al"), (3, 2, 5, "r", None)], "id long, project_id long, article_id long, text string, speaker_name string"),
    }
    children = {"roles": ("project_id", ["project_id", "firm_id", "role", "team"]), "quotes": ("project_id", ["project_id", "article_id", "text", "speaker_name"])}
    out = consolidate.merge_two(made, "projects", 1, 2, children, inherit=["source_article_id"])
    assert [tuple(r) for r in out["projects"].collect()] == [(1, "winner", 20)]
    assert sorted(r["id"] for r in out["roles"].collect()) == [1, 3] and {r["project_id"] for r in out["roles"].collect()} == {1}
    assert sorted(r["id"] for r in out["quotes"].collect()) == [1, 3]
    with pytest.raises(ValueError, match="distinct"):
        consolidate.check_merge(made["projects"], 1, 1)
    with pytest.raises(ValueError, match="not found"):
        consolidate.check_merge(made["projects"], 1, 99)


def test_merge_firms(spark):
    firms = spark.createDataFrame([(1, "Acme", ["old"]), (2, "Acme (east)", ["alias"]), (3, "Other", [])], "id long, name string, aliases array<string>")
    roots = consolidate.paren_clusters(firms.select("id", "name"))
    assert {r["id"]: r["root"] for r in roots.collect()} == {1: 1, 2: 1}
    out = {r["id"]: r["aliases"] for r in consolidate.merge_entities(firms, roots, aliases=True).collect()}
    assert out == {1: ["Acme (east)", "alias", "old"], 3: []}


def test_firms_merge_with_their_people_and_mentions(spark):
    df = spark.createDataFrame
    made = {
        "firms": df([(1, "Acme", []), (2, "Acme East", ["AE"])], "id long, name string, aliases array<string>"),
        "roles": df([(1, 9, 1, "r", "t"), (2, 9, 2, "r", "t"), (3, 9, 2, "s", "t"), (4, 9, 2, None, "t"), (5, 9, 2, None, "t")], "id long, project_id long, firm_id long, role string, team string"),
        "people": df([(1, "Al", 1), (2, "Al", 2), (3, "Bo", 2), (4, "Bo", 2), (5, "Al", None)], "id long, name string, firm_id long"),
        "quotes": df([(1, 2), (2, 3), (3, None)], "id long, speaker_person_id long"),
        "person_mentions": df([(1, 2), (2, 5)], "id long, canonical_id long"),
        "firm_mentions": df([(1, 2), (2, None)], "id long, canonical_id long"),
    }
    out = {k: sorted(tuple(r) for r in v.collect()) for k, v in consolidate.merge_firms(made, df([(2, 1)], "id long, root long")).items()}
    assert out["firms"] == [(1, "Acme", ["AE", "Acme East"])] and [r[0] for r in out["roles"]] == [1, 3, 4, 5] and {r[2] for r in out["roles"]} == {1}
    assert out["people"] == [(1, "Al", 1), (3, "Bo", 1), (5, "Al", None)]
    assert dict(out["quotes"]) == {1: 1, 2: 3, 3: None} and dict(out["person_mentions"]) == {1: 1, 2: 5} and dict(out["firm_mentions"]) == {1: 1, 2: None}
    firms = df([(1, "Acme", ["AE", "Acme East", "old"])], "id long, name string, aliases array<string>")
    back = consolidate.split_firm({"firms": firms, "firm_mentions": df([(1, 1, "AE"), (2, 1, "Acme")], "id long, canonical_id long, raw_text string")}, 1, "Acme East", ["AE"])
    assert {tuple(map(str, r)) for r in back["firms"].collect()} == {("1", "Acme", "['old']"), ("2", "Acme East", "['AE']")}
    assert {r["id"]: r["canonical_id"] for r in back["firm_mentions"].collect()} == {1: 2, 2: 1}


def test_closure(spark):
    assert {r["id"]: r["root"] for r in graph.merged_roots(spark.createDataFrame([(7, 7), (8, 7), (3, 3), (None, 1)], "a long, b long")).collect()} == {7: 7, 8: 7, 3: 3}
    got = {r["id"]: r["root"] for r in graph.merged_roots(spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1)], "a long, b long")).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}


def test_writes_are_idempotent(spark):
    base = spark.createDataFrame([(1, "a", None), (2, None, "x")], "id long, k string, v string")
    rows = spark.createDataFrame([(3, "a", "y"), (4, "b", "z"), (5, "b", "w"), (6, None, "n"), (7, None, "m")], "id long, k string, v string")
    once = upsert.insert_if_absent(base, rows, ["k"], ["id"], nulls_distinct=False)
    assert sorted(r["id"] for r in once.collect()) == [1, 2, 4]
    assert once.count() == upsert.insert_if_absent(once, rows, ["k"], ["id"], nulls_distinct=False).count()
    assert sorted(r["id"] for r in upsert.insert_if_absent(base, rows, ["k"], ["id"]).collect()) == [1, 2, 4, 6, 7]
    first = upsert.first_by_key(rows.withColumn("w", F.lit(1)), ["k"], ["v"], nulls_distinct=True).collect()
    assert sorted(r["id"] for r in first) == [3, 5, 6, 7]
    numbered = upsert.with_ids(rows.repartition(3), ["v"], start=10).collect()
    assert [r["v"] for r in sorted(numbered, key=lambda r: r["id"])] == ["m", "n", "w", "y", "z"] and min(r["id"] for r in numbered) == 11


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ids_have_no_gap_nor_repeat(spark, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(1_200_000).selectExpr("pmod(xxhash64(id), 900000) AS k", "id AS v", "repeat('x', 20) AS payload")
        got = upsert.with_ids(rows, ["k", "v"]).agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id"), F.countDistinct("v")).first()
        assert tuple(got) == (1_200_000, 1_200_000, 1, 1_200_000, 1_200_000)
        some = upsert.with_ids(rows.where("v < 5000"), ["k", "v"]).orderBy("id").select("k", "v").collect()
        assert some == sorted(some)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_classification(spark):
    roles = spark.createDataFrame([(1, 7, "Architect", "design"), (2, 7, "Engineer", "design"), (3, 7, "Architect", "design"), (4, 8, "Engineer", "design"), (5, 8, "Architect", "design"), (6, None, "x", "design")], "id long, firm_id long, role string, team string")
    got = {r["firm_id"]: (r["firm_type"], r["firm_type_aux"]) for r in classify.firm_types(roles).collect()}
    assert got == {7: ("architect", ["engineer"]), 8: ("engineer", ["architect"])}
    firms = spark.createDataFrame([(7, "architect", ["engineer"]), (8, "unknown", [])], "id long, firm_type string, firm_type_aux array<string>")
    assert [r["id"] for r in classify.planned_types(firms, roles).collect()] == [8]


def test_probes(spark):
    panel = {"owner": "City (land)", "project": {"name": "Tower", "state": "ut", "cost": "$2 million", "year_completed": "2020"}, "design_team": [{"role": "Architect", "firm": "A (core)"}, {"role": "", "firm": "B"}], "construction_team": None, "owner_rep": "R"}
    rows = [(1, "project_panel", json.dumps(panel)), (2, "claims", json.dumps({"claims": [{"text": "c", "type": "stat", "page": "7"}, {"text": " "}]})), (3, "quotes", "```json\n" + json.dumps({"quotes": [{"text": "q", "page": 3}]}) + "\n```"), (4, "claims", "not json")]
    out = probes.materialize(spark.createDataFrame(rows, "article_id long, probe string, output string"))
    assert [tuple(r) for r in out["roles"].orderBy("team").collect()] == [(1, "A", "Architect", "design", "core"), (1, "City", "Owner", "owner", "land")]
    assert out["projects"].select("name", "state", "cost_usd", "year_completed").first()[:] == ("Tower", "UT", 2_000_000, 2020)
    assert [tuple(r) for r in out["claims"].select("text", "page").collect()] == [("c", 7)] and out["quotes"].select("page").first()[0] == 3
    work = spark.createDataFrame([(1, "ok"), (2, "bad")], "id long, text string")

    def call(t):
        if t == "bad":
            raise RuntimeError("no")
        return json.dumps({"t": t})

    got = {r["id"]: json.loads(r["output"]) for r in probes.run_external(work, call).collect()}
    assert got == {1: {"t": "ok"}, 2: {"_error": "no"}}
    import pandas as pd

    assert list(probes.repair_json(pd.Series(['{"a": [1, 2', '{"a": "b', '[1, 2,]', None, "```json\n{}\n```"]))) == ['{"a": [1, 2]}', '{"a": "b"}', "[1, 2]", None, "{}"]


def test_truncated_answers_are_read(spark):
    rows = [(1, "claims", '{"claims": [{"text": "whole", "type": "stat", "page": 1}, {"text": "cut of'), (2, "claims", "no"), (3, "claims", None), (4, "project_panel", json.dumps({"summary": "s", "author": "By Al,"}))]
    out = probes.materialize(spark.createDataFrame(rows, "article_id long, probe string, output string"))
    assert [r["text"] for r in out["claims"].orderBy("pos").collect()] == ["whole", "cut of"]
    assert [tuple(r) for r in out["articles"].collect()] == [(4, "s", "Al")]
    words = spark.createDataFrame([("K-12",), ("barn",), (None,)], "t string").select(probes.in_vocabulary("t", probes.TYPOLOGIES).alias("ok"))
    assert [r["ok"] for r in words.collect()] == [True, False, True]
    assert spark.range(1).select(probes.within_caps("claims", F.array(*map(F.lit, range(16))))).first()[0] is False


def test_calls_are_repeated_while_failures_may_pass():
    waits, tries = [], []

    def call(x):
        tries.append(x)
        if len(tries) < 3:
            raise probes.Transient("busy")
        return x

    assert probes.retrying(call, wait=waits.append)("q") == "q" and waits == [10.0, 20.0]
    with pytest.raises(probes.Transient):
        probes.retrying(lambda: (_ for _ in ()).throw(probes.Transient("x")), attempts=6, wait=waits.append)()
    assert waits[2:] == [10.0, 20.0, 40.0, 80.0, 120.0]
    with pytest.raises(KeyError):
        probes.retrying(lambda: {}["x"], wait=waits.append)()


def test_probes_run_once(spark):
    asked = spark.createDataFrame([(1, "claims", 3, "Ask.", True), (2, "quotes", 3, "Fail.", True), (3, "old", 1, "No.", False)], "id long, name string, version int, prompt string, active boolean")
    articles = spark.createDataFrame([(7, "T", "project_feature", 4, ["one", None], None), (8, None, None, 1, ["two"], "h"), (9, "ad", "advertisement", 1, ["x"], "h")], "id long, title string, article_type string, page_start int, pages array<string>, content_hash string")

    def call(text):
        if text.startswith("Fail"):
            raise RuntimeError("no")
        return json.dumps({"text": text})

    runs, stats = probes.run_probes(asked, articles, tables.empty(spark, "probe_runs"), call)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"runs": 2, "cache_hits": 0, "errors": 2}
    got = {r["article_id"]: json.loads(r["output_json"])["text"] for r in runs.collect()}
    assert got[7] == "Ask.\n\n--- Article title: T ---\n\n--- Page 4 (extracted text) ---\none\n\n--- Page 5 (extracted text) ---\n" and got[8].endswith("--- Page 1 (extracted text) ---\ntwo")
    again, stats = probes.run_probes(asked, articles, runs, call)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"runs": 0, "cache_hits": 2, "errors": 2} and again.count() == 2
    shown = spark.range(1).select(probes.rendered(F.lit("p"), F.lit(""), F.lit(2), F.array(F.lit("t")), F.array(F.lit("gs://x")))).first()[0]
    assert shown == "p\n\n--- Page 2 (extracted text) ---\nt\n\n--- Page 2 (image) ---\ngs://x"


def test_geocoding(spark):
    known = tables.conform(spark.createDataFrame([(1, "Main St", "Northport", "UT", None, None), (2, None, None, None, None, None), (3, "Nowhere", None, None, 1.0, None), (4, "Main St", "Northport", "UT", None, "Kept")], "id long, location string, city string, state string, lat double, county string"), "projects")
    tries = []

    def backend(q):
        tries.append(q)
        if q.startswith("Nowhere"):
            return json.dumps({"status": "ZERO_RESULTS", "results": []})
        return json.dumps({"status": "OK", "results": [{"geometry": {"location": {"lat": 11.5, "lng": -21.5}}, "address_components": [{"long_name": "Alder County", "types": ["administrative_area_level_2"]}]}]})

    out, stats = geocode.sweep(known, backend)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"geocoded": 2, "no_query": 1, "no_match": 1}
    assert {r["id"]: (r["lat"], r["lng"], r["county"]) for r in out.collect()} == {1: (11.5, -21.5, "Alder"), 2: (None, None, None), 3: (1.0, None, None), 4: (11.5, -21.5, "Kept")}
    assert geocode.sweep(known, backend, dry_run=True)[0] is known


def test_issues_are_taken_in(spark, tmp_path):
    from tessera.sources.store import Store

    store = Store(spark, str(tmp_path))
    store.write("probes", spark.createDataFrame([(k + 1, p.name, p.version, p.prompt, p.schema, p.model, True) for k, p in enumerate(probes.REGISTRY)], tables.schema("probes")))
    assert store.versions("probes") == [1] and store.read("issues").count() == 0
    pages = spark.createDataFrame([("2021_May.pdf", k, f"page {k}") for k in range(1, 8)], "filename string, page int, text string")

    def segmenter(text):
        return json.dumps({"segments": [{"page_start": 1, "page_end": "2", "title": "A", "type": "project_feature"}, {"page_start": "9", "title": "Ad", "type": "advertisement"}]} if "Page 1 " in text else [{"page_start": 6, "page_end": 7, "title": "B", "author": "x"}])

    def prober(text):
        if text.startswith("Describe"):
            return json.dumps({"summary": "s", "author": "by Ann", "project": {"name": "Harbour Tower", "state": "UT"}, "owner": "City", "design_team": [{"role": "Architect", "firm": "Basalt House"}]})
        if text.startswith("List up to 15"):
            return json.dumps({"claims": [{"text": "c", "page": 1}, {"text": "c", "page": 2}]})
        return json.dumps({"quotes": [{"text": "q", "speaker_name": "Al", "speaker_firm": "basalt house"}]})

    out, stats = ingest.ingest(store.all(), pages, segmenter, prober)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"runs": 6, "cache_hits": 0, "errors": 0}
    assert [tuple(r) for r in out["issues"].select("id", "filename", "year", "month_label", "page_count").collect()] == [(1, "2021_May.pdf", 2021, "May", 7)]
    got = out["articles"].orderBy("id").select("title", "page_start", "page_end", "author", "summary", "primary_project_id").collect()
    assert [tuple(r) for r in got] == [("A", 1, 2, "Ann", "s", 1), ("Ad", 1, 1, None, None, None), ("B", 6, 7, "Ann", "s", 2)]
    assert sorted(r["name"] for r in out["firms"].collect()) == ["Basalt House", "City"] and out["projects"].count() == 2
    assert sorted(tuple(r) for r in out["roles"].select("project_id", "role", "team").collect()) == [(1, "Architect", "design"), (1, "Owner", "owner"), (2, "Architect", "design"), (2, "Owner", "owner")]
    assert out["quotes"].where("speaker_person_id is null").count() == 0 and out["people"].count() == 1 and out["article_projects"].where("is_primary").count() == 2
    assert out["claims"].groupBy("article_id").count().where("count > 1").count() == 0
    for name, df in out.items():
        store.write(name, df)
    again, stats = ingest.ingest(store.all(), pages, segmenter, prober)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"runs": 0, "cache_hits": 0, "errors": 0} and again["articles"].count() == 3
    forced, stats = ingest.ingest(store.all(), pages, segmenter, prober, force=True)
    assert {r["outcome"]: r["n"] for r in stats.collect()} == {"runs": 0, "cache_hits": 6, "errors": 0}
    assert forced["projects"].count() == 2 and forced["claims"].count() == 2 and forced["roles"].count() == 4


def test_stages_in_order():
    seen = []
    stages = [("first", lambda: seen.append(1)), ("bad", lambda: 1 / 0), ("last", lambda: seen.append(3))]
    out = ingest.rehearse(stages, tolerated=("bad",))
    assert seen == [1, 3] and isinstance(out["bad"], ZeroDivisionError)
    assert list(ingest.rehearse(stages, gate=lambda done: False)) == ["first"]
    with pytest.raises(ZeroDivisionError):
        ingest.rehearse(stages)


def test_probe_cache(spark):
    due = probes.due(spark.createDataFrame([(1, 4), (2, 3)], "probe_id long, version int"), spark.createDataFrame([(7, "h"), (8, None)], "article_id long, content_hash string"), spark.createDataFrame([(1, 7, 4, "h"), (2, 7, 3, "old"), (2, 8, 3, None)], "probe_id long, article_id long, probe_version int, content_hash string"))
    assert sorted((r["probe_id"], r["article_id"]) for r in due.collect()) == [(1, 8), (2, 7)]


def test_all_probes_are_due(spark):
    articles, runs = spark.createDataFrame([(7, "h")], "article_id long, content_hash string"), spark.createDataFrame([(3, 7, 1, "h")], "probe_id long, article_id long, probe_version int, content_hash string")
    assert probes.due(spark.range(1500).selectExpr("id as probe_id", "1 as version"), articles, runs).count() == 1499


def test_issue_states(spark):
    got = probes.issue_state(spark.createDataFrame([(1, "a"), (2, "b")], "id long, filename string"), spark.createDataFrame([(9, 1)], "id long, issue_id long"), spark.createDataFrame([("a",), ("b",), ("c",)], "filename string"))
    assert {r["filename"]: r["state"] for r in got.collect()} == {"a": "skip", "b": "resume", "c": "fresh"}


def test_contexts(spark):
    row = spark.createDataFrame([("Tower", "Al", "Boss", "Acme", "It works", "stat")], "project_name string, speaker_name string, speaker_title string, speaker_firm string, text string, type string")
    assert row.select(documents.quote_text()).first()[0] == "It works — Al, Boss, at Acme (project: Tower)"
    assert row.select(documents.claim_text()).first()[0] == "[Tower, stat] It works"
    firm = spark.createDataFrame([("Acme", "unknown", ["A", "B"], "Architect")], "name string, firm_type string, aliases array<string>, roles_played string")
    assert firm.select(documents.firm_text()).first()[0] == "Acme | Also known as: A, B | Roles: Architect"
    rows = spark.createDataFrame([(1, "abc", None), (2, "", None), (3, "xyz", [1.0])], "id long, t string, embedding array<double>")
    out = {r["id"]: r["embedding"] for r in documents.embed_missing(rows, F.col("t")).collect()}
    assert sum(out[1]) == 1.0 and out[2] is None and out[3] == [1.0]


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.1]), (4, [0.0, 0.0])], "id long, embedding array<float>")
    assert [r["id"] for r in vectors.nearest(rows, [1.0, 0.0], 2).collect()] == [1, 3]
    each = vectors.nearest_each(rows, rows.where("id < 3").select(F.col("id").alias("query_id"), F.col("embedding").alias("query")), 1).collect()
    assert {(r["query_id"], r["id"]) for r in each} == {(1, 1), (2, 2)}
    none = spark.createDataFrame([], "query_id long, query array<float>")
    assert vectors.nearest_each(rows, none, 3).collect() == []
    odd = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, None]), (4, [1.0, 0.0]), (5, [1.0]), (None, [1.0, 0.0])], "id long, embedding array<float>")
    got = vectors.nearest_each(odd, spark.createDataFrame([(9, [2.0, 0.0])], "query_id long, query array<double>"), 3).orderBy("rank").collect()
    assert [(r["id"], r["similarity"]) for r in got] == [(1, 1.0), (4, 1.0), (2, None)]


def test_nearest_each_holds_little_and_is_dealt_out(spark):
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    some = rng.integers(-3, 4, (3000, 4)).astype(float)  # many ties
    some[:5] = 0
    unit = some / np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-300)
    block = lambda at: [pa.array([(np.arange(len(some))[at]).tobytes()], pa.binary()), pa.array([4], pa.int32()), pa.array([np.where(some[at].any(axis=1, keepdims=True), unit[at], np.nan).tobytes()], pa.binary())]
    names = ["ids", "width", "data", "query_ids", "query_width", "query_data"]
    pairs = [pa.RecordBatch.from_arrays([*block(slice(k, k + 300)), *block(slice(q, q + 300))], names) for k in range(0, 3000, 300) for q in range(0, 3000, 300)]
    held, whole = vectors.HELD, pa.Table.from_batches(vectors._best(3, 6)(iter(pairs)))
    assert whole.num_rows == 9000  # three a query, though each query met ten blocks
    vectors.HELD = 4000
    try:
        parts = list(vectors._best(3, 6)(iter(pairs)))
    finally:
        vectors.HELD = held
    assert max(p.num_rows for p in parts) <= 4000 + 900  # what is held, and the last pair's
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(some)], "id long, embedding array<double>").coalesce(1)
    near = vectors.nearest_each(rows, rows.select(F.col("id").alias("query_id"), F.col("embedding").alias("query")), 3, digits=6)
    assert "Exchange RoundRobinPartitioning" in near._jdf.queryExecution().toString() or "RoundRobinPartitioning" in near._jdf.queryExecution().executedPlan().toString()
    got = {(r["query_id"], r["rank"]): (r["id"], r["similarity"]) for r in near.collect()}
    score = np.where(some.any(axis=1)[:, None] & some.any(axis=1)[None, :], np.round(unit @ unit.T, 6), -np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(3000), score.shape), -score), axis=1)[:, :3]
    assert got == {(q, k + 1): (int(order[q, k]), None if score[q, order[q, k]] == -np.inf else score[q, order[q, k]]) for q in range(3000) for k in range(3)}


def test_teaming_is_dealt_out_by_rows(spark, monkeypatch):
    monkeypatch.setattr(graph, "ROLE_ROWS", 50)
    roles = spark.createDataFrame([(p, f, f % 3) for p in range(60) for f in (p % 7, p % 5 + 2, p % 5 + 2, 9)] + [(None, 1, 1), (None, 2, 2), (3, None, None)], "p long, f long, kind long")
    assert graph.spread(roles) == 5
    assert graph.teaming(roles, "p", "f")._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression [p#") == 2
    firms = {p: {p % 7, p % 5 + 2, 9} for p in range(60)}
    wanted = {}
    for some in firms.values():
        for a in some:
            for b in some:
                if a < b:
                    wanted[a, b] = wanted.get((a, b), 0) + 1
    assert {(r["a"], r["b"]): r["n_projects"] for r in graph.teaming(roles, "p", "f").collect()} == wanted
    alike = {k: n for k, n in wanted.items() if k[0] % 3 == k[1] % 3}
    assert {(r["a"], r["b"]): r["n_projects"] for r in graph.teaming(roles, "p", "f", within=["kind"]).collect()} == alike


def test_project_pairs_are_dealt_out_by_key(spark, monkeypatch):
    monkeypatch.setattr(projects, "CANDIDATE_ROWS", 10)
    rows = tables.conform(spark.range(60).select("id", F.concat(F.lit("hall "), F.col("id") % 2).alias("name")), "projects")
    pairs = projects.find_candidates(rows, rows)  # of two names
    scored = projects.score_candidates(pairs, rows, rows)
    assert scored.rdd.getNumPartitions() == 6
    assert scored.count() == 60 * 8 and scored.select("key").distinct().count() == 60


def test_sources(spark, tmp_path):
    pages = spark.createDataFrame([(1, '<a href="/a%20b.PDF?x">'), (2, '<a href="/a%20b.PDF?x"><a href="/c.html">')], "page_id long, html string")
    got = links.harvest(pages, base="https://cdn", suffix="").orderBy("url").collect()
    assert [(r["page_id"], r["file_name"]) for r in got] == [(1, "a b.PDF"), (2, "c.html")]
    scored = signals.score_pages(spark.createDataFrame([("Owner: x\nARCHITECT : y\nCost: z",), (None,)], "text string"))
    assert [r["score"] for r in scored.collect()] == [3]
    (tmp_path / "b.pdf").write_bytes(b"two|pages")
    (tmp_path / "a.txt").write_bytes(b"no")
    texts = readers.page_texts(readers.binary_issues(spark, str(tmp_path)), lambda b: [*b.decode().split("|"), None])
    assert [tuple(r) for r in texts.orderBy("page").collect()] == [("b.pdf", 1, "two"), ("b.pdf", 2, "pages"), ("b.pdf", 3, "")]
    widths = {r["column_name"]: r["width"] for r in sinks.column_widths(spark.createDataFrame([("x" * 90, "y")], "a string, b string")).collect()}
    assert widths == {"a": 60, "b": 5}
    path = sinks.write_version(scored, str(tmp_path / "t"), 3)
    assert path.endswith("v000003") and spark.read.parquet(path).count() == 1


def test_workbook(spark):
    import io
    import zipfile
    from xml.etree import ElementTree

    held = io.BytesIO()
    sinks.workbook({"Projects": spark.createDataFrame([("a <b>&c", 5, None), ("\x01é", 7, "x" * 90)], "name string, n long, long_text string"), "Team": spark.createDataFrame([], "firm string")}, held)
    book = zipfile.ZipFile(held)
    for name in book.namelist():
        ElementTree.fromstring(book.read(name))
    sheet = book.read("xl/worksheets/sheet1.xml").decode()
    assert "a &lt;b&gt;&amp;c" in sheet and "<v>7</v>" in sheet and 'width="60"' in sheet and sheet.count("<row>") == 3 and book.read("xl/worksheets/sheet2.xml").decode().count("<row>") == 1


def test_fetching(spark):
    rows = spark.createDataFrame([("u/a", "a"), ("u/b", "b"), ("u/c", "c")], "url string, file_name string")

    def fetch(url):
        if url.endswith("b"):
            raise OSError("gone")
        return url.encode()

    got = {r["file_name"]: (r["content"] and bytes(r["content"]), r["error"]) for r in links.fetched(rows, fetch, spark.createDataFrame([("c",)], "file_name string")).collect()}
    assert got == {"a": (b"u/a", None), "b": (None, "gone")}


def test_table_contracts(spark):
    for name in tables.SCHEMAS:
        tables.assert_contract(tables.empty(spark, name), name)
    with pytest.raises(ValueError, match="filename"):
        tables.assert_contract(spark.range(1), "issues")
    made = {"issues": tables.conform(spark.createDataFrame([(1, "a"), (2, "b")], "id long, filename string"), "issues"), "articles": tables.conform(spark.createDataFrame([(5, 1), (6, 2)], "id long, issue_id long"), "articles"), "claims": tables.conform(spark.createDataFrame([(8, 5), (9, 6)], "id long, article_id long"), "claims")}
    out = tables.cascade_delete(made, "issues", spark.createDataFrame([(1,)], "id long"))
    assert [[r["id"] for r in out[t].collect()] for t in made] == [[2], [6], [9]]


def test_streams(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").write.parquet(source)
    run = incremental.sweep(incremental.files(spark, source, "id long, name string"), lambda df, k: seen.extend(r["id"] for r in df.collect()), str(tmp_path / "state"))
    run.awaitTermination()
    again = incremental.sweep(incremental.files(spark, source, "id long, name string"), lambda df, k: seen.extend(r["id"] for r in df.collect()), str(tmp_path / "state"))
    again.awaitTermination()
    assert sorted(seen) == [1, 2]
