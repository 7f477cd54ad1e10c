"""Listings, checks and further formats around the corpus' files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files(listing: DataFrame, processed: DataFrame, file: str = "file") -> DataFrame:
    """Files of a listing that are not processed yet."""
    return listing.join(processed.select(file).distinct(), file, "left_anti")


def newest(listing: DataFrame, group: str, file: str = "file") -> DataFrame:
    """The last file by name of each group."""
    return listing.groupBy(group).agg(F.max(file).alias(file))


def damaged(contents: DataFrame, sums: DataFrame, path: str = "path", content: str = "content", md5: str = "md5") -> DataFrame:
    """Files whose MD5 differs from the published one."""
    return contents.select(path, F.md5(content).alias("__md5")).join(sums, path).where(F.col("__md5") != F.col(md5)).select(path)


def is_fresh(spark: SparkSession, output: str, inputs: list[str]) -> bool:
    """Whether ``output`` is there and newer than all inputs, by the file system's own times."""
    jvm = spark.sparkContext._jvm

    def changed(path: str) -> int:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else -1

    at = changed(output)
    return at >= 0 and all(changed(x) <= at for x in inputs)


def first_documents(docs: DataFrame, n: int = 10, ord_col: str = "ord") -> DataFrame:
    return docs.orderBy(ord_col).limit(n)


def write_xml(rows: DataFrame, path: str, row_tag: str = "PubmedArticle", root_tag: str = "PubmedArticleSet") -> None:
    """Records as XML with a header and a footer around them."""
    rows.write.format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def bioc_xml(spark: SparkSession, path: str) -> DataFrame:
    """``(file, id, type, concept, text)``: the annotations of BioC documents; placeholder ids are left out."""
    schema = "id string, passage array<struct<annotation:array<struct<infon:array<struct<_key:string,_VALUE:string>>,text:string>>>>"
    rows = spark.read.format("xml").option("rowTag", "document").schema(schema).load(path)
    rows = rows.select(F.col("_metadata.file_name").alias("file"), "id", F.explode("passage").alias("p")).select("file", "id", F.explode("p.annotation").alias("a"))
    info = lambda key: F.get(F.filter("a.infon", lambda x: x["_key"] == key), F.lit(0))["_VALUE"]
    rows = rows.select("file", "id", info("type").alias("type"), info("identifier").alias("concept"), F.col("a.text").alias("text"))
    return rows.where("concept is not null and concept not in ('', '-', 'None')")


def redirect_target(url: Column, name: str = "redirectUrl") -> Column:
    """The decoded target of a redirect's query parameter."""
    return F.url_decode(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1))


def earlier_date(a: Column, b: Column) -> Column:
    """The earlier of two structs (year, month, day), missing parts last."""
    late = lambda d: F.struct(*[F.coalesce(d[c], F.lit(9999)).alias(c) for c in ("year", "month", "day")])
    first = F.least(late(a), late(b))
    return F.struct(*[F.nullif(first[c], F.lit(9999)).alias(c) for c in ("year", "month", "day")])


def link_paths(html: Column, patterns: list[str]) -> Column:
    """Sorted distinct matches of path patterns, quotes off."""
    every = F.flatten(F.array(*[F.regexp_extract_all(html, F.lit(p), F.lit(0)) for p in patterns]))
    return F.array_sort(F.array_distinct(F.transform(every, lambda x: F.translate(x, "\"'", ""))))
