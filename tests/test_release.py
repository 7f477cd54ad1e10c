import pytest
from pyspark.sql import functions as F

from lithos.operators import release
from lithos.sources import files


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_relevance(spark):
    rows = [("About corona", 2020, None, None), ("About corona", 2001, None, None), ("MERS-CoV (2012) here", None, None, None), ("xMERS-CoV", 2001, ["D1"], None), (None, None, None, ["C9"]), ("other", 2020, ["Z"], [])]
    df = spark.createDataFrame(rows, "t string, y int, m array<string>, s array<string>")
    keys = release.usable_keywords([" mers-cov (2012) ", "MERS-CoV", "cov"], vague=("CoV",))
    got = df.select(release.is_relevant(F.coalesce("t", F.lit("")), F.col("y"), F.col("m"), F.col("s"), "corona", keys, ["D1", "C9"])).collect()
    assert keys == ["mers-cov", "mers-cov (2012)"] and [r[0] for r in got] == [True, False, True, True, True, False]


def test_virus_rules(spark):
    df = spark.createDataFrame([(["MERS-CoV", "SARS-CoV"], 2005), (["SARS-CoV-2", "SARS-CoV"], 2020), (["SARS-CoV-2"], 2018), (["SARS-CoV-2"], 0), (["MERS-CoV"], None)], "v array<string>, y int")
    assert [r[0] for r in df.select(release.plausible_viruses(F.col("v"), F.col("y"))).collect()] == [["SARS-CoV"], ["SARS-CoV-2"], [], ["SARS-CoV-2"], ["MERS-CoV"]]
    c = spark.createDataFrame([(1, 0, 5, "a", "V1", ["V1"]), (1, 0, 5, "b", "V2", ["V1"]), (2, 0, 5, "a", "V1", ["V1", "V2"]), (3, 0, 5, "d", None, [])], "doc_id long, start int, end int, id string, associated_virus string, viruses array<string>")
    assert rows_of(release.resolve_by_virus(c, "viruses").select("doc_id", "id")) == [(1, "a"), (3, "d")]
    hits = spark.createDataFrame([("L1", "Location", "Reading"), ("L1", "Location", "reading"), ("x", "Drug", "y")], "id string, type string, text string")
    assert rows_of(release.exact_case(hits, spark.createDataFrame([("L1", "Reading")], "id string, alias string"))) == [("L1", "Location", "Reading"), ("x", "Drug", "y")]


def test_final_filter_and_projection(spark):
    e = "array<struct<type:string,normalized:string>>"
    df = spark.createDataFrame([("d1", "u", ["Virus"], [("Virus", "V")], [], []), ("d2", None, [], [], [], []), ("d3", "u", ["NotAllEnglish"], [], [], []), ("d4", "u", None, [("Drug", "x")], [("Mutation", "m")], [])], f"doi string, url string, annotations array<string>, entities {e}, variants {e}, viral_lineages {e}")
    out = release.final_filter(df, spark.createDataFrame([("d9",)], "doi string"))
    assert rows_of(out.select("doi", F.size("entities"))) == [("d1", 1), ("d4", 2)]
    assert rows_of(release.with_viruses(df, ["SARS-CoV-2"]).select("doi", "viruses")) == [("d1", ["V"])]
    with pytest.raises(ValueError):
        release.projected(out)
    with pytest.raises(ValueError):
        release.append_checked(df, df.select("doi"))
    with pytest.raises(ValueError):
        release.lookup_one(df, url="u")
    assert release.lookup_one(df, doi="d1").first().url == "u"


def test_files(spark, tmp_path):
    (tmp_path / "b.xml").write_text("<collection><document><id>7</id><passage><annotation><infon key='type'>Gene</infon><infon key='identifier'>12</infon><text>abc</text></annotation><annotation><infon key='type'>Gene</infon><infon key='identifier'>-</infon><text>q</text></annotation></passage></document></collection>")
    assert rows_of(files.bioc_xml(spark, str(tmp_path / "b.xml")).select("id", "type", "concept", "text")) == [("7", "Gene", "12", "abc")]
    df = spark.createDataFrame([("http://x/?a=1&redirectUrl=http%3A%2F%2Fy%2Fz",)], "u string")
    assert df.select(files.redirect_target(F.col("u"))).first()[0] == "http://y/z"
    d = spark.createDataFrame([((2020, 5, None), (2020, 4, 2)), ((None, None, None), (2019, None, None))], "a struct<year:int,month:int,day:int>, b struct<year:int,month:int,day:int>")
    assert [tuple(r[0]) for r in d.select(files.earlier_date(F.col("a"), F.col("b"))).collect()] == [(2020, 4, 2), (2019, None, None)]
    files.write_xml(spark.createDataFrame([(1, "t")], "PMID long, Title string"), str(tmp_path / "out"))
    back = spark.read.format("xml").option("rowTag", "PubmedArticle").load(str(tmp_path / "out"))
    assert rows_of(back) == [(1, "t")]
    assert files.is_fresh(spark, str(tmp_path / "out"), [str(tmp_path / "b.xml")]) and not files.is_fresh(spark, str(tmp_path / "none"), [])
    listing = spark.createDataFrame([("g", "a1"), ("g", "a2"), ("h", "b1")], "g string, file string")
    assert rows_of(files.newest(listing, "g")) == [("g", "a2"), ("h", "b1")]
    assert rows_of(files.new_files(listing, listing.limit(0)).select("file")) == [("a1",), ("a2",), ("b1",)]
