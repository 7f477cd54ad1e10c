"""Rules over made-up records against the rows that must come out."""

import pytest

from tests import fixture_cases


@pytest.mark.parametrize("name", sorted(fixture_cases.QUERIES))
def test_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    df = fixture_cases.QUERIES[name](spark, "")
    rel = duckdb.connect().execute(fixture_cases.ORACLE[name])
    names = [x[0] for x in rel.description]
    want = sorted(tuple(str(r[names.index(c)]) for c in df.columns) for r in rel.fetchall())
    assert sorted(names) == sorted(df.columns) and sorted(tuple(map(str, r)) for r in df.collect()) == want
