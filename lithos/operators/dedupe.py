"""Duplicate resolution: groups over several keys, survivors, and checks of the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.functions import dates
from lithos.functions.text import canonical_url, strip_punctuation
from lithos.operators.components import connected_components

# Journals that are preprint servers.
PREPRINT_SERVERS = ("arXiv", "bioRxiv", "ChemRxiv", "medRxiv")
IDS = ("doi", "pubmed_id", "pmcid", "url", "cord_uid")


def duplicate_groups(rows: DataFrame, ord_col: str, keys: dict[str, Column]) -> DataFrame:
    """``(ord, group_id)``: rows that share any key are one group, named by its least ``ord``.

    A null key links nothing. For each key one row a value, the least, is linked with the
    others, so a key held by n rows gives n links.
    """
    named = F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(v).alias("a"), F.xxhash64(v, F.lit(k)).alias("b"), v.isNotNull().alias("some")) for k, v in keys.items()])
    each = rows.select(F.col(ord_col).alias("ord"), F.inline(named)).where("some").drop("some")
    least = each.groupBy("kind", "a", "b").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1")
    links = each.join(least, ["kind", "a", "b"]).where("ord != first").select(F.col("ord").alias("src"), F.col("first").alias("dst"))
    parts = connected_components(links)
    return rows.select(F.col(ord_col).alias("ord")).join(parts.withColumnRenamed("node", "ord"), "ord", "left").select("ord", F.coalesce("component", "ord").alias("group_id"))


def survivors(rows: DataFrame, group_col: str, fields: list[str], order: list[Column], *more: Column) -> DataFrame:
    """One row a group: of each field the last value that is neither null nor "" in ``order``.

    ``order`` must end in something unique. All fields come from one aggregation, without a
    window over the group, as do ``more``, other aggregates.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    text = {f.name for f in rows.schema if f.dataType.typeName() == "string"}
    some = lambda f: F.col(f).isNotNull() & ((F.col(f) != "") if f in text else F.lit(True))
    last = [F.max_by(F.col(f), F.when(some(f), rank)).alias(f) for f in fields]
    return rows.groupBy(group_col).agg(F.count("*").alias("n"), *last, *more)


def violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``(kind, key, n)``: values of each key that more than one row holds."""
    each = rows.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in keys])))
    return each.where("key is not null and key != ''").groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")


def _some(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def merge_keys(rows: DataFrame) -> dict[str, Column]:
    """The seven keys by which publication records are one: four ids, and year and title with authors, abstract or journal.

    Titles, abstracts and journals count in lower case without punctuation; authors count as they are written,
    so a list and a string never meet. A key with an empty part is none, nor is one with a title under 20
    characters or an abstract under 50.
    """
    low = lambda c: strip_punctuation(F.lower(c))
    authors = _some("authors") if rows.schema["authors"].dataType.typeName() == "string" else F.when(F.size("authors") > 0, F.concat(F.lit("list:"), F.to_json("authors")))
    year = F.when(F.col("publish_year") != 0, F.col("publish_year").cast("string"))
    title = F.when(F.length("title") >= 20, low("title"))
    third = {"authors": authors, "abstract": F.when(F.length("abstract") >= 50, low("abstract")), "journal": low(_some("journal"))}
    ids = {c: _some(c) for c in ("doi", "pubmed_id", "cord_uid", "pmcid")}
    # concat gives null where a part is null.
    return ids | {f"title and {k}": F.concat(year, F.lit("\x1f"), title, F.lit("\x1f"), v) for k, v in third.items()}


def merged_documents(rows: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One document for each group of records that share a key.

    Of each field the last value that is not empty counts, preprints first by journal, then other records by
    the lengths of title and abstract. If a PubMed record (no cord_uid, but a pubmed_id) has a date, CORD records
    lose theirs; the date with most parts counts, the later of equals. A group of several gets in
    ``ids_from_merged_documents`` the sorted distinct ids of each kind, of URLs those of PubMed; a single record
    stays as it is. Then come ``url`` by priority of ids and ``is_preprint``. All in one aggregation.
    """
    groups = duplicate_groups(rows, ord_col, merge_keys(rows)).withColumnRenamed("ord", "__ord")
    rows = rows.join(groups, F.col(ord_col) == F.col("__ord")).drop("__ord")
    served = F.coalesce(F.col("journal").isin(*PREPRINT_SERVERS), F.lit(False))
    size = lambda c: F.when(served, 0).otherwise(F.coalesce(F.length(c), F.lit(0)))
    order = [(~served).cast("int"), F.when(served, F.col("journal")).otherwise(""), size("title"), size("abstract"), F.col(ord_col)]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    date = ("publish_year", "publish_month", "publish_day")
    own = F.struct(*[F.col(c).alias(c) for c in date])
    filled = lambda d: sum((d[c].isNotNull().cast("int") for c in date), F.lit(0))
    cord = _some("cord_uid").isNotNull()
    dated = sum((F.coalesce(F.col(c), F.lit(0)) for c in date), F.lit(0)) > 0
    without = F.struct(*[F.when(~cord, F.col(c)).alias(c) for c in date])
    best = lambda d, name: F.max_by(d, F.struct(filled(d), rank)).alias(name)
    parts = F.transform(F.split(F.coalesce("url", F.lit("")), ";"), lambda u: F.trim(u))
    pubmed = F.transform(F.filter(parts, lambda u: u.contains("www.ncbi.nlm.nih.gov/pubmed/")), lambda u: F.regexp_replace(u, "/+$", ""))
    sets = {c: F.array_distinct(F.flatten(F.collect_set(pubmed))) if c == "url" else F.collect_set(_some(c)) for c in IDS}
    fields = [c for c in rows.columns if c not in ("group_id", *date)]
    more = [best(own, "__all"), best(without, "__rest"), F.bool_or(~cord & _some("pubmed_id").isNotNull() & dated).alias("__pubmed")]
    more += [F.array_sort(v).alias(f"__ids_{c}") for c, v in sets.items()]
    more += [F.max_by(c, rank).alias(f"__one_{c}") for c in fields]
    out = survivors(rows, "group_id", fields, order, *more)
    text = {f.name for f in rows.schema if f.dataType.typeName() == "string"}
    chosen = F.when(F.col("__pubmed"), F.col("__rest")).otherwise(F.col("__all"))
    value = lambda c: F.when(F.col("n") == 1, F.col(f"__one_{c}")).otherwise(F.coalesce(c, F.lit("")) if c in text else F.col(c)).alias(c)
    ids = F.when(F.col("n") > 1, F.struct(*[F.col(f"__ids_{c}").alias(c) for c in IDS])).alias("ids_from_merged_documents")
    out = out.select("group_id", *[value(c) for c in fields], *[chosen[c].alias(c) for c in date], ids)
    return out.withColumns({"url": canonical_url(F.col("doi"), F.col("pmcid"), F.col("pubmed_id"), F.col("url")), "is_preprint": F.coalesce(F.col("journal").isin(*PREPRINT_SERVERS), F.lit(False))})


def document_faults(docs: DataFrame, as_of: Column, ord_col: str = "ord") -> DataFrame:
    """``(ord, fault)``: documents without an id, with a DOI of another format, or with a date that is none or after ``as_of``."""
    none = F.coalesce(*[_some(c) for c in ("doi", "pubmed_id", "cord_uid", "url")]).isNull()
    y, m, d = (F.col(c) for c in ("publish_year", "publish_month", "publish_day"))
    full = F.try_make_date(y, F.coalesce(m, F.lit(1)), F.coalesce(d, F.lit(1))) if hasattr(F, "try_make_date") else F.make_date(y, F.coalesce(m, F.lit(1)), F.coalesce(d, F.lit(1)))
    valid = dates.is_valid(y, m, d)
    tests = {
        "no id": none,
        "doi format": _some("doi").isNotNull() & ~F.col("doi").rlike(r"^[0-9.]+/.+[^/]$"),
        "date": ~valid,
        "future date": F.when(valid, F.coalesce(full > as_of, F.lit(False))).otherwise(False),
    }
    return docs.select(F.col(ord_col).alias("ord"), F.explode(F.array_compact(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]))).alias("fault"))
