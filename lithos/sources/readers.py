"""Readers and writers of the corpus' formats."""

from __future__ import annotations

import html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = (
    "ord bigint, pubmed_id string, pmcid string, doi string, cord_uid string, title string, abstract string, authors array<string>, journal string, journaliso string, "
    "publish_year int, publish_month int, publish_day int, medline_pubtype array<string>, reference_count int, url string"
)


def json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A (gzipped) JSON array of records."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Gzipped JSON lines with columns in alphabetical order."""
    df.select(*sorted(df.columns)).write.option("compression", "gzip").json(path)


def csv_table(spark: SparkSession, path: str) -> DataFrame:
    """A quoted CSV with a header, all columns strings."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True)


def tsv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", quote="")


def line_set(spark: SparkSession, path: str) -> DataFrame:
    """The distinct lines of a file, trimmed and in lower case, as ``line``."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("line")).where("line != ''").distinct()


def latest_per_key(rows: DataFrame, key: str, file: str, order: str) -> DataFrame:
    """The last row of each key in the last file that has it."""
    last = Window.partitionBy(key).orderBy(F.desc(file), F.desc(order))
    return rows.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def pubmed_xml(spark: SparkSession, path: str) -> DataFrame:
    """Articles of PubMed XML files: ids, title, abstract, date, language, authors and publication types.

    Sections of an abstract are joined by line breaks, a vernacular title stands in for a missing one.
    """
    schema = """MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,VernacularTitle:string,Language:string,
      Journal:struct<Title:string,ISOAbbreviation:string,JournalIssue:struct<PubDate:struct<Year:string,Month:string,Day:string,MedlineDate:string>>>,
      Abstract:struct<AbstractText:array<string>>,AuthorList:struct<Author:array<struct<LastName:string,ForeName:string,CollectiveName:string>>>,
      PublicationTypeList:struct<PublicationType:array<string>>>>,
      PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"""
    raw = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(schema).load(path)
    a, date = F.col("MedlineCitation.Article"), F.col("MedlineCitation.Article.Journal.JournalIssue.PubDate")
    ids = F.col("PubmedData.ArticleIdList.ArticleId")
    one = lambda kind: F.get(F.filter(ids, lambda x: x["_IdType"] == kind), F.lit(0))["_VALUE"]
    months = "jan feb mar apr may jun jul aug sep oct nov dec".split()
    table = F.create_map(*[F.lit(x) for i, m in enumerate(months) for x in (m, i + 1)])
    month = F.coalesce(F.col("m").try_cast("int"), table[F.lower(F.substring("m", 1, 3))])
    name = lambda x: F.coalesce(F.nullif(F.concat_ws(" ", x["ForeName"], x["LastName"]), F.lit("")), x["CollectiveName"])
    rows = raw.select(
        F.col("MedlineCitation.PMID").alias("pubmed_id"),
        one("pmc").alias("pmcid"),
        one("doi").alias("doi"),
        F.coalesce(F.nullif(F.trim(a["ArticleTitle"]), F.lit("")), a["VernacularTitle"]).alias("title"),
        F.array_join(F.coalesce(a["Abstract"]["AbstractText"], F.array().cast("array<string>")), "\n").alias("abstract"),
        a["Language"].alias("language"),
        F.transform(a["AuthorList"]["Author"], name).alias("authors"),
        a["Journal"]["Title"].alias("journal"),
        a["Journal"]["ISOAbbreviation"].alias("journaliso"),
        F.coalesce(date["Year"], F.regexp_extract(date["MedlineDate"], r"([0-9]{4})", 1)).try_cast("int").alias("publish_year"),
        F.coalesce(date["Month"], F.regexp_extract(date["MedlineDate"], r"([A-Z][a-z]{2})", 1)).alias("m"),
        date["Day"].try_cast("int").alias("publish_day"),
        a["PublicationTypeList"]["PublicationType"].alias("medline_pubtype"),
        F.col("_metadata.file_name").alias("file"),
    )
    return rows.withColumn("publish_month", month).drop("m")


@F.pandas_udf(T.StringType())
def unescape(x: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return x.map(lambda t: None if t is None else html.unescape(t))


# Names of tags that say nothing about a paper, and classes of spans whose text is metadata.
NOISE = frozenset((
    "status_code", "url_history", "resolved_url", "robots", "viewport", "referrer", "google-site-verification", "sessionEvt-audSegment", "sessionEvt-freeCntry", "sessionEvt-idGUID",
    "sessionEvt-individual", "sessionEvt-instId", "sessionEvt-instProdCode", "sessionEvt-nejmSource", "sessionEvt-offers", "sessionEvt-prodCode", "evt-ageContent", "evt-artView", "format-detection",
))
SPAN_CLASSES = ("article-header__journal", "primary-heading", "highwire-article-collection-term")


class _Meta(HTMLParser):
    """Metadata tags, spans with data attributes, and all the text of spans of some classes, nested elements too."""

    def __init__(self):
        super().__init__()
        self.found: dict[str, set[str]] = {}
        self.spans: list[tuple[list[str], list[str]]] = []  # the open ones: their classes, and their text so far

    def _add(self, name: str, value: str) -> None:
        if name not in NOISE:
            self.found.setdefault(name, set()).add(value)

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "meta" and a.get("name") is not None and a.get("content") is not None:
            self._add(a["name"], a["content"])
        if tag == "span":
            if a.get("data-attribute") is not None and a.get("data-value") is not None:
                self._add(a["data-attribute"], a["data-value"])
            self.spans.append(([c for c in SPAN_CLASSES if c in (a.get("class") or "").split()], []))

    def handle_endtag(self, tag):
        if tag == "span" and self.spans:
            for name in self.spans[-1][0]:
                self._add(name, "".join(self.spans[-1][1]))
            self.spans.pop()

    def handle_data(self, data):
        for _, text in self.spans:
            text.append(data)

    def close(self):
        super().close()
        while self.spans:  # those that are never closed reach to the end
            self.handle_endtag("span")


@F.pandas_udf(T.MapType(T.StringType(), T.ArrayType(T.StringType())))
def page_metadata(pages: pd.Series) -> pd.Series:
    """Named metadata of HTML pages: tag to sorted distinct values."""

    def one(page):
        parser = _Meta()
        parser.feed(page or "")
        parser.close()
        return {k: sorted(v) for k, v in sorted(parser.found.items())}

    return pages.map(one)
