from pyspark.sql import functions as F

from lithos.operators import analytics
from lithos.sources import readers


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_shares_of_the_topics_that_are_frequent_overall(spark):
    rows = [("m1", ["a", "a", "b"]), ("m1", ["c"]), ("m1", []), ("m2", ["a"]), ("m2", None), (None, ["c", "c"]), ("m2", [None, "b"])]
    df = spark.createDataFrame(rows, "m string, t array<string>")
    got = rows_of(analytics.top_shares(df, "m", "t", 2))
    assert got == [("m1", "a", 1, 33.33, 3), ("m1", "b", 1, 33.33, 3), ("m2", "a", 1, 33.33, 3), ("m2", "b", 1, 33.33, 3)]
    assert rows_of(analytics.top_shares(df.where("m = 'm1'"), "m", "t", 9))[2] == ("m1", "c", 1, 33.33, 3)
    assert analytics.top_shares(df.limit(0), "m", "t").count() == 0


def test_names_by_their_overall_count(spark):
    rows = [(1, "v", "k", "a"), (1, "v", "k", "a"), (1, "w", "k", "a"), (2, "v", "k", "b"), (3, "w", "k", "b"), (4, "w", "k", "c"), (5, "w", "q", "z")]
    df = spark.createDataFrame(rows, "d long, g string, k string, n string")
    got = rows_of(analytics.top_by_overall(df, "d", "g", "k", "n", 1))
    assert got == [("v", "k", "b", 1, 2), ("v", "q", "z", 0, 1), ("w", "k", "b", 1, 2), ("w", "q", "z", 1, 1)]
    assert analytics.top_by_overall(df.limit(0), "d", "g", "k", "n").count() == 0


def test_rare_values_fold_by_their_total(spark):
    df = spark.createDataFrame([("j1", "a"), ("j1", "a"), ("j2", "a"), ("j1", "b"), ("j2", "c")], "g string, v string")
    assert rows_of(analytics.rare_fold_by(df, "g", "v", 2)) == [("j1", "Other", 1), ("j1", "a", 2), ("j2", "Other", 1), ("j2", "a", 1)]


def test_concepts_count_once_a_document_and_spelling(spark):
    rows = [(1, 2020, "Gene", "g", "x"), (1, 2020, "Gene", "g", "x"), (1, 2020, "Gene", "g", "X"), (2, 2020, "Gene", "g", "x"), (2, 2021, "Species", "s", "y"), (2, 2021, "Gene", "-", "y"), (2, 2021, "Gene", None, "y")]
    df = spark.createDataFrame(rows, "d long, y int, type string, id string, text string")
    assert rows_of(analytics.concept_years(df, "d", "y", "Species")) == [(2020, "Gene", "g", 3)]


def test_the_largest_rises(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1), ("b", 1), ("c", 0)], "k string, p int")
    got = [tuple(r) for r in analytics.top_changes(df, "k", F.col("p") == 0, F.col("p") == 1, 2).collect()]
    assert got == [("b", 0.0, 66.666667, 66.666667), ("a", 50.0, 33.333333, -16.666667)]
    assert analytics.top_changes(df.limit(0), "k", F.col("p") == 0, F.col("p") == 1).count() == 0


def test_page_metadata_as_it_stands(spark):
    page = (
        '<meta name="a" content=" v "><meta name="a" content="v"><meta name="viewport" content="w"><meta name="n"><meta charset="x">'
        '<span class="x highwire-article-collection-term">T <i>in<span data-attribute="k" data-value="d">ner</span></i></span>'
        '<span class="article-type">no</span><span class="primary-heading">open <b>end'
    )
    df = spark.createDataFrame([(page,), (None,), ("",), ("<p>none",)], "h string")
    got = [r[0] for r in df.select(readers.page_metadata("h")).collect()]
    assert got == [{"a": [" v ", "v"], "highwire-article-collection-term": ["T inner"], "k": ["d"], "primary-heading": ["open end"]}, {}, {}, {}]
