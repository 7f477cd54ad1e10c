"""Every query with SQL against DuckDB on the smallest tables."""

import os

import pytest

from lithos.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    rel = duck.sql(catalog.ORACLE[name])
    rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    want = sorted(tuple(str(r[i]) for i in at) for r in rows)
    assert sorted(tuple(map(str, r)) for r in df.collect()) == want
