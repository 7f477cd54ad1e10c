import datetime
import gzip
import json

import pytest
from pyspark.sql import functions as F

from lithos.functions import dates
from lithos.functions import text as tx
from lithos.operators import dedupe, joins, mentions, ml, rules, star, variants, web
from lithos.sources import readers
from lithos.streaming import incremental


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_cleaning_rules(spark):
    cases = [
        ("  Title: A study—of x()() ", "A study-of x"),
        ("[A study of y].", "A study of y"),
        ("Original title : title: Z", "Z"),
        ("", ""),
    ]
    df = spark.createDataFrame(cases, "raw string, want string")
    assert [r.got for r in df.select(tx.clean_title(F.col("raw")).alias("got")).collect()] == [w for _, w in cases]
    cases = [
        ("No abstract available.", ""),
        ("Abstract: Methods:we ran at 12:30 ", "Methods: we ran at 12: 30"),
        ("We found x. Copyright © 2020 Someone\nnext line", "We found x. \nnext line"),
        ("Done. All rights reserved.", "Done."),
    ]
    df = spark.createDataFrame(cases, "raw string, want string")
    assert [r.got for r in df.select(tx.clean_abstract(F.col("raw")).alias("got")).collect()] == [w for _, w in cases]


def test_partial_dates(spark):
    df = spark.createDataFrame([("",), ("2020",), ("2021-02-30",), ("2020-02-29",), ("x",)], "t string").select(dates.parse_partial(F.col("t")).alias("d")).select("d.*")
    got = df.select("*", dates.is_valid(F.col("year"), F.col("month"), F.col("day")).alias("ok")).collect()
    assert [tuple(r) for r in got] == [(None, None, None, True), (2020, None, None, True), (2021, 2, 30, False), (2020, 2, 29, True), (None, None, None, True)]
    df = spark.createDataFrame([(2030, 1, 5), (2024, 1, 31), (2025, 7, None)], "year int, month int, day int")
    got = df.select(dates.clamp_future(F.col("year"), F.col("month"), F.col("day"), F.lit(datetime.date(2024, 1, 31))).alias("d")).select("d.*")
    assert [tuple(r) for r in got.collect()] == [(2024, 1, None), (2024, 1, 31), (2024, None, None)]
    assert df.select(dates.epoch_noon(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"))).first()[0] == 1577880000


def test_groups_that_merge_through_a_third_row(spark):
    df = spark.createDataFrame([(0, "d1", None), (1, None, "p1"), (2, "d1", "p1"), (3, None, None), (4, "d4", None)], "ord long, doi string, pmid string")
    got = {r.ord: r.group_id for r in dedupe.duplicate_groups(df, "ord", {"doi": F.col("doi"), "pmid": F.col("pmid")}).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4}


def test_survivor_takes_the_last_filled_value(spark):
    df = spark.createDataFrame([(1, 0, "a", "x", True), (1, 1, "", "y", False), (1, 2, None, "", None)], "g long, ord long, t string, u string, f boolean")
    r = dedupe.survivors(df, "g", ["t", "u", "f"], [F.col("ord")]).first()
    assert (r.n, r.t, r.u, r.f) == (3, "a", "y", False)


def test_priority_join_takes_a_present_key_even_with_a_null_value(spark):
    left = spark.createDataFrame([(1, "c1", "p1"), (2, None, "p1"), (3, "c9", "p9")], "id long, cord string, pubmed string")
    side = spark.createDataFrame([("c1", "q", 0, None), ("z", "p1", 1, "old"), ("z", "p1", 2, "new")], "c string, p string, ord long, v string")
    got = rows_of(joins.priority_join(left, [("cord", side, "c"), ("pubmed", side, "p")], "ord", "v").select("id", "matched_by", "value"))
    assert got == [(1, "cord", None), (2, "pubmed", "new"), (3, None, None)]


def test_release_merge_keeps_one_null_id(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2)], "id string, ord long")
    new = spark.createDataFrame([("a", 3), (None, 4), (None, 5), ("", 6)], "id string, ord long")
    assert rows_of(joins.release_merge(old, new, "id", "ord").select("id", "ord")) == [("", 6), ("a", 1), ("a", 2), (None, 4)]


def test_memo_split_and_point_updates(spark):
    rows = spark.createDataFrame([("t", None), ("u", "x")], "title string, abstract string")
    done, todo = joins.memo_split(rows, spark.createDataFrame([("t", None, 7)], "title string, abstract string, out long"), ["title", "abstract"])
    assert rows_of(done) == [("t", None, 7)] and rows_of(todo) == [("u", "x")]
    df = spark.createDataFrame([("d1", "p1", "old")], "doi string, pubmed_id string, journal string")
    fixed = joins.point_updates(df, [{"doi": "d1", "field": "doi", "to": "d2"}, {"doi": "d2", "field": "journal", "to": "new"}], keys=("doi", "pubmed_id"))
    assert rows_of(fixed) == [("d2", "p1", "new")]


def test_longest_and_unambiguous_mentions(spark):
    docs = spark.createDataFrame([(1, ["spike", "protein", "gene", "spike"])], "doc_id long, w array<string>")
    lookup = spark.createDataFrame([("spike", "a"), ("spike protein", "b"), ("gene", "c"), ("gene", "d")], "alias string, id string")
    hits = mentions.longest(mentions.ngram_mentions(docs, "w", lookup))
    assert rows_of(hits.select("pos", "n", "id")) == [(0, 2, "b"), (2, 1, "c"), (2, 1, "d"), (3, 1, "a")]
    assert rows_of(mentions.unambiguous(hits).select("pos", "id")) == [(0, "b"), (3, "a")]


def test_rule_categories(spark):
    df = spark.createDataFrame([(["Review", "Meta-analysis"], "t", "see NCT 12345", "j"), (None, "Chapter 3", "", "j"), ([], "t", "x", rules.WEEKLY_REPORT), ([], "t", "x", "j")], "c array<string>, t string, a string, j string")
    got = [r[0] for r in df.select(rules.rule_categories(F.col("c"), F.col("t"), F.col("a"), F.col("j"))).collect()]
    assert got == [["Clinical Trials", "Meta-analysis", "Research"], ["Book chapter"], ["CDC Weekly Report"], ["Research"]]


def test_variants():
    forms = lambda t, **k: [(x[2], x[4]) for x in variants.find(t, **k)]
    assert forms("p.Val600Glu, V600E and c.76A>T rs12345") == [("variant", "p.V600E"), ("variant", "p.V600E"), ("variant", "c.76A>T"), ("variant", "rs12345")]
    assert forms("the 501Y.V2 variant, B.1.1.7") == [("lineage", "B.1.351 (South Africa)"), ("lineage", "B.1.1.7 (UK)")]
    assert forms("T47D cells", stop=frozenset(["t47d"])) == [] and forms(None) == [] and forms("serine for glycine at position 12") == [("variant", "p.G12S")]
    assert len(variants.compiled()) == 154
    assert forms("THR790-to-MET791, 790THR----MET") == [("variant", "p.T790M")]  # an ignored phrasing blanks what others would find
    assert [x[:2] for x in variants.find("T790E/V/M")] == [(0, 5), (5, 7), (7, 9)]


def test_sources(spark, tmp_path):
    with gzip.open(tmp_path / "docs.json.gz", "wt") as f:
        json.dump([{"title": "a", "n": 1}, {"title": "b"}], f)
    assert rows_of(readers.json_array(spark, str(tmp_path / "docs.json.gz"), "title string, n int")) == [("a", 1), ("b", None)]
    (tmp_path / "p.xml").write_text(
        "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>12</PMID><Article><Journal><Title>J</Title><JournalIssue><PubDate><MedlineDate>2019 Nov-Dec</MedlineDate></PubDate></JournalIssue></Journal>"
        "<ArticleTitle>T &amp; U</ArticleTitle><Abstract><AbstractText>one</AbstractText><AbstractText>two</AbstractText></Abstract><AuthorList><Author><LastName>L</LastName><ForeName>F</ForeName></Author>"
        "<Author><CollectiveName>G</CollectiveName></Author></AuthorList><Language>eng</Language></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType='doi'>10.1/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle></PubmedArticleSet>"
    )
    r = readers.pubmed_xml(spark, str(tmp_path / "p.xml")).first()
    assert (r.pubmed_id, r.doi, r.title, r.abstract, r.authors, r.publish_year, r.publish_month) == ("12", "10.1/x", "T & U", "one\ntwo", ["F L", "G"], 2019, 11)
    df = spark.createDataFrame([('<meta name="k" content="v"><span class="primary-heading">H</span>',), (None,)], "h string")
    assert [r[0] for r in df.select(readers.page_metadata("h")).collect()] == [{"k": ["v"], "primary-heading": ["H"]}, {}]


def test_stream_adds_new_files_only(spark, tmp_path):
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.createDataFrame([("a",), ("b",)], "k string").coalesce(1).write.parquet(src)
    assert rows_of(incremental.drain_counts(spark, src, "k string", ["k"], state)) == [("a", 1), ("b", 1)]
    spark.createDataFrame([("a",)], "k string").write.mode("append").parquet(src)
    assert rows_of(incremental.drain_counts(spark, src, "k string", ["k"], state)) == [("a", 2), ("b", 1)]


def test_classifiers_and_what_if(spark):
    rows = spark.createDataFrame([(i, "good fine text" if i % 2 else "poor weak text", i % 2) for i in range(40)], "id long, t string, y int")
    for kind in ("LR", "SVM", "RF"):
        features, models = ml.fit_labels(rows, ["y"], ["t"], kind, features=64)
        got = ml.predict_labels(rows, features, models).collect()
        least = 0 if kind == "SVM" else 0.5
        assert all((r.y_score > least) == bool(r.y) for r in got), kind
    train = spark.createDataFrame([([0.0], 0), ([1.0], 1)], "x array<double>, y int")
    pool = spark.createDataFrame([([v / 5],) for v in range(-10, 15)], "x array<double>")
    cand = spark.createDataFrame([(7, [3.0]), (8, [0.5])], "id long, x array<double>")
    got = {r.id: r for r in ml.what_if(train, pool, cand).collect()}
    assert set(got) == {7, 8} and got[7].if_1 > got[7].if_0
    assert got[7]["mean"] == (got[7].if_0 + got[7].if_1) / 2 and got[7].least == min(got[7].if_0, got[7].if_1)
    picked = ml.greedy(train, pool, cand, 3)
    assert [i for i, _ in picked] in ([7, 8], [8, 7]) and picked[0][1] == max(r.least for r in got.values())
    with pytest.raises(ValueError):
        ml.what_if(train, pool, cand, most=1)


def test_star_schema(spark):
    e = "array<struct<type:string,normalized:string,id:string,start:int,end:int,section:string>>"
    df = spark.createDataFrame([(0, "t", 2020, None, None, [("Drug", "x", "d1", 3, 4, "title"), ("Virus", "v", "v1", 0, 1, "title")]), (1, "u", None, None, None, [("Drug", "x", "d1", 0, 1, "abstract")])], f"ord long, title string, publish_year int, publish_month int, publish_day int, entities {e}")
    t = star.star_tables(df)
    assert rows_of(t["entities"].select("entity_id", "type", "name", "doc_count")) == [(1, "Drug", "x", 2), (2, "Virus", "v", 1)]
    assert rows_of(t["annotations"]) == [(0, 1), (0, 2)]
    terms = spark.createDataFrame([("d1", 1.5, 2.5)], "id string, longitude double, latitude double")
    assert rows_of(star.coordinates(t["entities"], terms, "Drug")) == [(1, 1.5, 2.5)]


def test_web(spark):
    df = spark.createDataFrame([(0, "", "Jour X", {"citation_abstract": ["<b>" + "w" * 120 + "</b>", "//" + "c" * 200], "citation_journal_title": ["Journal X"], "articleType": ["Editorial"]}, None), (1, "kept", "jour x", {}, ["Retracted Publication"])], "ord long, abstract string, journal string, meta map<string,array<string>>, pub array<string>")
    got = web.web_journal(df).select("ord", web.backfilled_abstract(F.col("abstract"), F.col("meta")).alias("a"), "journal", web.inferred_article_type(F.lit("t"), F.col("meta"), F.col("pub")).alias("k"))
    assert rows_of(got) == [(0, "w" * 120, "Journal X", "Comment/Editorial"), (1, "kept", "Journal X", "Retracted")]
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("z", "y")], "child string, parent string")
    assert rows_of(web.transitive(edges, "a")) == [("a", 0), ("b", 1), ("c", 2)]


@pytest.mark.parametrize("name", ["page_title"])
def test_entry_lists_queries(name):
    import __spark_entry__

    assert name in __spark_entry__.queries() and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
