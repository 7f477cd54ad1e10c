"""A training corpus from ``documents``: the stages in order, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``
and keep or drop whole documents; the last returns the packed pieces. Every stage judges a row by its
own text, whatever its id: rows that share an id, or have none, neither drop nor save each other.
An empty table passes through, and columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.llm import decontaminate, language_id, near_dup, packing, secrets
from lithos.session import staged, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: without text or without a letter. A missing ``lang`` becomes the predicted one.

    Where no document has a language there is none to predict, and those with a letter stay as they are.
    """
    model = language_id.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    if not model.families:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model, lang_out="__lang", score_out="__score").where("__lang != 'und'")
    return found.select(*[F.coalesce("lang", "__lang").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each near-duplicate group, that with the least id (rows without one come last), and one row of it."""
    found = staged(near_dup.near_duplicates(docs, by_text=True), "groups")
    own = F.xxhash64("text")

    def those(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("__id"), F.col("hash").alias("__hash")).hint("merge")  # they grow with the corpus: never broadcast
        return docs.join(keys, docs["doc_id"].eqNullSafe(keys["__id"]) & (own == keys["__hash"]), how)

    gone = found.where("not kept").select("doc_id", "hash").distinct()
    repeated = found.where("kept and n_shingles > 0").groupBy("doc_id", "hash").count().where("count > 1").select("doc_id", "hash")
    if repeated.isEmpty():
        return those(gone, "left_anti")
    return those(gone.unionByName(repeated), "left_anti").unionByName(those(repeated, "left_semi").dropDuplicates(["doc_id", "text"]))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item.

    Each row is judged by its own text: rows with one text have one verdict, so the digest of
    the text is the key, whatever the ids.
    """
    key = F.sha2(F.col("text").cast("binary"), 256)
    found = decontaminate.contamination(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("__gone")).distinct().hint("merge")
    return docs.join(gone, key == gone["__gone"], "left_anti")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a secret span of any kind."""
    found = secrets.scan(docs, keep=docs.columns)
    return found.where((F.size("found.base") == 0) & (F.size("found.added") == 0)).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("near_dup", one_of_each_group),
    ("decontaminate", uncontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Trained models and token ids are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
