import pytest
from pyspark.sql import functions as F

from tessera.plans.ask import alerts, ask, comparable


def test_only_reads(spark):
    t = {"firms": spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")}
    assert [r["n"] for r in ask(spark, "```sql\nSELECT count(*) AS n FROM firms;\n```", t).collect()] == [2]
    assert [r["t"] for r in ask(spark, "SELECT 'InsertInto Create' AS t FROM firms WHERE name <> '; Drop'", t, limit=1).collect()] == ["InsertInto Create"]
    assert ask(spark, "with x as (select * from firms) select * from x", t, limit=1).count() == 1
    for bad in ("DROP VIEW firms", "INSERT INTO firms VALUES (1, 'x')", "WITH x AS (SELECT 1 AS id, 'a' AS name) INSERT INTO firms SELECT * FROM x", "", "SELECTION"):
        with pytest.raises(ValueError, match="only SELECT"):
            ask(spark, bad, t)


def test_comparable_and_alerts(spark):
    p = spark.createDataFrame([(1, [1.0, 0.0], "UT"), (2, [0.9, 0.1], "UT"), (3, [1.0, 0.0], "NV")], "id long, embedding array<double>, state string")
    assert [r["id"] for r in comparable(p, [1.0, 0.0], 2, F.col("state") == "UT").collect()] == [1, 2]
    seen = spark.sql("SELECT 1L AS project_id, 'x' AS source_ref, timestamp'2024-01-02' AS first_seen UNION ALL SELECT 1L, 'y', timestamp'2023-01-01'")
    assert [r["source_ref"] for r in alerts(spark.createDataFrame([(7, 1)], "watch_id long, project_id long"), seen, "2024-01-01").collect()] == ["x"]
