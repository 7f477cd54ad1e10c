"""Queries against their SQL on documents that the test tables do not hold."""

import pytest

from lithos.plans import catalog

TEXTS = ["plain words", "password=c1234567890123456a", "B.1.1.7 and rs12345, T790M", "", None, "a149c\nG to A substitution at position 93", "née 20I/501Y.V1", "c.93_94del"]


def written(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def same(spark, d, name, tables):
    con = pytest.importorskip("duckdb").connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet/*.parquet')")
    df, rel = catalog.QUERIES[name](spark, d), con.sql(catalog.ORACLE[name])
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(str, r)) for r in df.collect()) == sorted(tuple(str(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", ["variants_fixture", "variants_in_documents"])
def test_variants_in_a_documents_own_text(spark, tmp_path, name):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(6 * len(TEXTS))]
    d = written(spark, tmp_path, documents=(rows, "doc_id long, text string"))
    same(spark, d, name, ["documents"])


def test_articles_have_headings_types_and_every_kind_of_date(spark, tmp_path):
    """As many of each as the cases of ``fixture_cases`` hold, and records without an article among them."""
    d = written(spark, tmp_path, documents=([(i, "t", f"src{i % 3}") for i in range(420)], "doc_id long, text string, source string"))
    same(spark, d, "pubmed_articles", ["documents"])
    rows = catalog.QUERIES["pubmed_articles"](spark, d).collect()
    assert len(rows) == 420 and {"mesh", "types"} < set(rows[0].asDict())
    assert {(r.y, r.m, r.d) for r in rows} == {(2020, 5, None), (2019, 11, None), (None, None, None), (2018, 6, None), (2018, 3, 9), (2018, 2, 3), (2017, 1, 2)}
    assert {r.abstract for r in rows} >= {"", "text   after"} and {r.authors for r in rows} == {"Ann Lee;A Group", "Lee", ""} and {r.doi is None for r in rows} == {True, False}


def test_places_of_rows_that_share_an_id(spark, tmp_path):
    items = [(i, f"alpha{'' if i % 7 else ' beta'} gamma delta") for i in (0, 7, 14)] + [(1, "gamma word"), (8, "word")]
    docs = [(1, "alpha beta gamma"), (1, "beta alpha word"), (2, "word gamma"), (3, None)]
    d = written(spark, tmp_path, documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string"))
    same(spark, d, "ambiguity_drop", ["documents", "benchmark"])
    assert catalog.QUERIES["ambiguity_drop"](spark, d).count()


def test_categories_are_counted_in_one_pass_without_texts(spark):
    from tests.test_oracle import DATA

    df = catalog.QUERIES["multiset_diff"](spark, DATA)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text#") and sum("Relation [doc_id" in line and "text" in line for line in plan.splitlines()) == 1
    assert "ctr[0-9]" in plan and "ctr[0-9]" not in plan.split("Join", 1)[0]  # the pattern is below the join
