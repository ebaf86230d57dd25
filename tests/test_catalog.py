"""Every query with SQL gives the same rows as DuckDB."""

import os

import pandas as pd
import pytest

from tessera.plans import catalog

FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(None if pd.api.types.is_scalar(v) and pd.isna(v) else float(v) if isinstance(v, float) else str(v) for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-6 * max(1, abs(a))


def plain(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, got = rows(catalog.QUERIES[name](spark, FOLDER).toPandas())
    wanted_columns, wanted = rows(duck.sql(catalog.ORACLE_SQL[name]).df())
    assert columns == wanted_columns
    assert len(got) == len(wanted)
    bad = [(x, y) for x, y in zip(sorted([tuple(map(plain, r)) for r in got], key=repr), sorted([tuple(map(plain, r)) for r in wanted], key=repr), strict=True) if not all(map(same, x, y))]
    assert not bad, bad[:3]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
