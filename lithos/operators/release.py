"""From tagged documents to a release: relevance, virus rules, final filter, projection, process record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of a release, in order.
RELEASE = (
    "cord_uid", "pubmed_id", "doi", "pmcid", "url", "journal", "publish_year", "publish_month", "publish_day",
    "title", "abstract", "is_preprint", "topics", "articletypes", "entities",
)
REQUIRED = ("title", "abstract", "journal", "publish_year")
#: A virus cannot be meant before its year of discovery; the newest is the only one where it is present.
FIRST_YEAR = {"SARS-CoV": 2002, "MERS-CoV": 2012, "SARS-CoV-2": 2019}
NEWEST = "SARS-CoV-2"


def append_checked(docs: DataFrame, extra: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """``docs`` and hand-made rows; a column that must be there and is not raises ValueError."""
    missing = [c for c in required if c not in extra.columns]
    if missing or not extra.where(" or ".join(f"{c} is null" for c in required)).isEmpty():
        raise ValueError(f"added documents lack required fields: {missing or list(required)}")
    return docs.unionByName(extra, allowMissingColumns=True)


def usable_keywords(keywords: list[str], vague: tuple[str, ...] = ()) -> list[str]:
    """Lower case, trimmed, distinct, without vague ones."""
    return sorted({k.strip().lower() for k in keywords} - {v.lower() for v in vague} - {""})


def is_relevant(text: Column, year: Column, mesh: Column, supplementary: Column, generic: str, keywords: list[str], ids: list[str], since: int = 2019) -> Column:
    """A recent text with the generic word, a keyword, or a listed heading or supplementary id."""
    low = F.lower(text)
    wanted = F.array(*[F.lit(i) for i in ids])
    none = F.array().cast("array<string>")
    word = F.lit(False)
    if keywords:
        quick = low.contains(keywords[0])
        for k in keywords[1:]:
            quick = quick | low.contains(k)
        word = quick & low.rlike(r"(^|[^a-z0-9_])(" + "|".join("".join(f"\\{c}" if c in r"\.^$*+?{}[]|()" else c for c in k) for k in keywords) + r")($|[^a-z0-9_])")
    recent = (year >= since) & low.contains(generic.lower())
    return F.coalesce(recent, F.lit(False)) | word | F.arrays_overlap(F.coalesce(mesh, none), wanted) | F.arrays_overlap(F.coalesce(supplementary, none), wanted)


def is_english(code: Column) -> Column:
    return F.lower(code).isin("en", "eng", "english")


def plausible_viruses(viruses: Column, year: Column) -> Column:
    """Viruses that a document of that year can mean; the newest alone where it is one of them. No year drops none."""
    table = F.create_map(*[F.lit(x) for pair in FIRST_YEAR.items() for x in pair])
    kept = F.filter(viruses, lambda v: F.coalesce(year, F.lit(0)).isin(0) | (year >= F.coalesce(table[v], F.lit(0))))
    return F.when(F.array_contains(kept, NEWEST), F.array(F.lit(NEWEST))).otherwise(kept)


def resolve_by_virus(candidates: DataFrame, viruses: str) -> DataFrame:
    """Of places whose candidates all depend on a virus, those of the document's only virus; none if it has not one.

    ``candidates`` has (doc_id, start, end, id, associated_virus) and the document's ``viruses``.
    """
    every = candidates.groupBy("doc_id", "start", "end").agg(F.bool_and(F.col("associated_virus").isNotNull()).alias("__all"))
    rows = candidates.join(every, ["doc_id", "start", "end"])
    own = (F.size(viruses) == 1) & (F.col("associated_virus") == F.get(viruses, F.lit(0)))
    return rows.where(~F.col("__all") | own).drop("__all")


def exact_case(hits: DataFrame, aliases: DataFrame, type_name: str = "Location") -> DataFrame:
    """Hits of one type only where the text has an alias in its exact case; ``aliases`` has (id, alias)."""
    ok = hits.where(F.col("type") == type_name).join(aliases.select("id", F.col("alias").alias("text")).distinct(), ["id", "text"], "left_semi")
    return hits.where(F.col("type") != type_name).unionByName(ok.select(hits.columns))


def with_viruses(docs: DataFrame, names: list[str]) -> DataFrame:
    """Documents with a virus, by entity or by hand label, and ``viruses``, sorted and distinct."""
    found = F.transform(F.filter("entities", lambda e: e["type"] == "Virus"), lambda e: e["normalized"])
    labelled = F.filter("annotations", lambda a: a.isin(*names))
    out = docs.withColumn("viruses", F.array_sort(F.array_distinct(F.concat(found, F.coalesce(labelled, F.array().cast("array<string>"))))))
    return out.where(F.size("viruses") > 0)


def final_filter(docs: DataFrame, held_back: DataFrame, flags: tuple[str, ...] = ("RemoveFromCorpus?", "NotAllEnglish")) -> DataFrame:
    """Without DOIs that are held back, without rows that have no URL or carry a flag; one array of mentions."""
    out = docs.join(held_back.select("doi").where("doi is not null").distinct(), "doi", "left_anti").where("url is not null")
    out = out.where(~F.coalesce(F.arrays_overlap("annotations", F.array(*[F.lit(f) for f in flags])), F.lit(False)))
    return out.withColumn("entities", F.concat("entities", "variants", "viral_lineages")).drop("variants", "viral_lineages")


def projected(docs: DataFrame) -> DataFrame:
    """The release's columns; one that is missing raises ValueError."""
    missing = [c for c in RELEASE if c not in docs.columns]
    if missing:
        raise ValueError(f"the release lacks {missing}")
    return docs.select(*RELEASE)


def name_conflicts(entities: DataFrame) -> DataFrame:
    """``(kind, key, n)``: ids with several names, and names of one type with several ids."""
    ids = entities.groupBy("id").agg(F.count_distinct("normalized").alias("n")).where("n > 1").select(F.lit("id").alias("kind"), F.col("id").alias("key"), "n")
    names = entities.groupBy("type", "normalized").agg(F.count_distinct("id").alias("n")).where("n > 1")
    return ids.unionByName(names.select(F.lit("name").alias("kind"), F.col("normalized").alias("key"), "n"))


def process_record(previous: DataFrame, *ids: DataFrame) -> DataFrame:
    """All ids seen so far, sorted and distinct; each frame has one column."""
    out = previous.toDF("id")
    for more in ids:
        out = out.union(more.toDF("id"))
    return out.where("id is not null").distinct().orderBy("id")


def search(docs: DataFrame, loaded: DataFrame, key: str, journal: str | None = None, title: str | None = None, content: str | None = None) -> DataFrame:
    """Documents not loaded yet whose journal, title or abstract holds the given words, case folded."""
    out = docs.join(loaded.select(key), key, "left_anti")
    for column, words in (("journal", journal), ("title", title), ("abstract", content)):
        if words:
            out = out.where(F.lower(column).contains(words.lower()))
    return out


def lookup_one(docs: DataFrame, **key) -> DataFrame:
    """The one document with a key; none or several raise ValueError."""
    ((column, value),) = key.items()
    out = docs.where(F.col(column) == value)
    if len(out.limit(2).collect()) != 1:
        raise ValueError(f"no single document has {column} = {value}")
    return out


def queue_is_empty(queue: DataFrame, annotations: DataFrame, key: str = "document_id") -> bool:
    """Whether each queued document has an annotation."""
    return queue.join(annotations.select(key), key, "left_anti").isEmpty()
