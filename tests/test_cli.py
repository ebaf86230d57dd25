"""The commands over a small folder of tables."""

import json

import pytest

from tessera.__main__ import main
from tessera.sources import tables
from tessera.sources.store import Store


def decide(rest):
    return rest.selectExpr("raw", "'new' AS decision", "cast(null AS long) AS canonical_id", "raw AS canonical_name", "0.8 AS confidence")


def same(pairs):
    return pairs.where("left_id = 4")


PLACE = """
def place(query):
    return '{"status": "OK", "results": [{"geometry": {"location": {"lat": 1.0, "lng": 2.0}}, "address_components": []}]}'
"""


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "tables"))
    df = lambda rows, kind: spark.createDataFrame(rows, kind)
    made.write("firms", df([(1, "Acme", ["x"], "unknown"), (2, "Acme (east)", [], "unknown"), (4, "Basalt House Partners of Nordia", [], None), (5, "Basalt House Partners in Nordia", [], None)], "id long, name string, aliases array<string>, firm_type string"))
    made.write("projects", df([(1, "Harbour Tower", "Northport"), (2, "harbour tower", None)], "id long, name string, city string"))
    made.write("roles", df([(1, 1, 1, "Architect", "design"), (2, 1, 2, "Architect", "design"), (3, 2, 1, "Architect (core)", "design"), (4, 2, 1, "Architect", "design")], "id long, project_id long, firm_id long, role string, team string"))
    made.write("firm_mentions", df([(1, "ACME", None, None, False), (2, "Nobody Inc", None, None, False)], "id long, raw_text string, canonical_id long, confidence float, corrected boolean"))
    made.write("articles", df([(1, "T", "project_feature", "s", 2), (2, "Ad", "advertisement", "s", None)], "id long, title string, article_type string, summary string, primary_project_id long"))
    made.write("article_projects", df([(1, 2, True)], "article_id long, project_id long, is_primary boolean"))
    made.write("claims", df([(1, 1, 2, "a claim", "stat")], "id long, article_id long, project_id long, text string, type string"))
    return made


def test_commands(spark, store, tmp_path, capsys):
    at = ["--tables", store.folder]
    (tmp_path / "some_geocoder.py").write_text(PLACE)
    spark.sparkContext.addPyFile(str(tmp_path / "some_geocoder.py"))
    run = lambda *args: (main([*args, *at], spark), [json.loads(x) for x in capsys.readouterr().out.splitlines()])[1]
    assert {x["outcome"]: x["n"] for x in run("resolve-firms", "--decide", f"{__name__}:decide")} == {"resolved_deterministic": 1, "created": 1}
    assert store.read("firms").where("name = 'Nobody Inc'").count() == 1 and store.read("firm_mentions").where("canonical_id is null").count() == 0
    assert run("consolidate", "--target", "firms") == [{"id": 2, "root": 1}] and len(store.versions("roles")) == 1
    run("consolidate", "--target", "firms", "--apply")
    assert sorted(r["id"] for r in store.read("roles").collect()) == [1, 3, 4] and "Acme (east)" in store.read("firms").where("id = 1").first()["aliases"]
    run("consolidate", "--target", "firms-fuzzy", "--decide", f"{__name__}:same", "--apply")
    assert store.read("firms").where("id = 5").count() == 0
    assert run("consolidate", "--target", "roles", "--apply") == [{"action": "delete", "n": 1}] and sorted(r["id"] for r in store.read("roles").collect()) == [1, 4]
    run("consolidate", "--target", "projects", "--apply")
    assert [r["id"] for r in store.read("projects").collect()] == [1] and store.read("articles").where("id = 1").first()["primary_project_id"] == 1
    assert [r["id"] for r in store.read("roles").collect()] == [1] and store.read("claims").first()["project_id"] == 1
    assert [x["new_type"] for x in run("classify-firms", "--only-unknown")] == ["architect"] and store.read("firms").where("id = 1").first()["firm_type"] == "architect"
    assert run("seed-probes")[0]["inserted"] == 3 and run("seed-probes")[0] == {"inserted": 0, "unchanged": 3}
    assert {x["table"]: x["embedded"] for x in run("embed")} == {"projects": 1, "articles": 1, "claims": 1, "quotes": 0, "firms": 3}
    assert run("geocode", "--backend", "some_geocoder:place", "--throttle-sec", "0") == [{"outcome": "geocoded", "n": 1}] and store.read("projects").first()["lat"] == 1.0
    run("workbook", "--output", str(tmp_path / "book"))
    assert spark.read.option("header", True).csv(str(tmp_path / "book/team")).count() == 1
    spark.createDataFrame([(1, '<a href="/x.pdf">'), (2, "Owner: a Cost: b Architect: c")], "page_id long, html string").selectExpr("*", "html AS text").write.parquet(str(tmp_path / "pages"))
    assert [x["url"] for x in run("harvest", "--pages", str(tmp_path / "pages"))] == ["/x.pdf"] and [x["score"] for x in run("score-pages", "--pages", str(tmp_path / "pages"))] == [3]
    for name in tables.SCHEMAS:
        tables.assert_contract(store.read(name), name)
    with pytest.raises(SystemExit):
        main(["consolidate", "--target", "firms-fuzzy", *at], spark)
