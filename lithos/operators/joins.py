"""Joins and merges by several keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority_join(left: DataFrame, sides: list[tuple[str, DataFrame, str]], order: str, value: str, out: str = "value") -> DataFrame:
    """The value of the first key of ``left`` that its side holds, and which key that was.

    ``sides`` lists (left column, side, side column) by priority. A side that repeats a key
    counts with its last row by ``order``. A key that is present wins even if its value is null.
    """
    for i, (key, side, side_key) in enumerate(sides):
        last = side.where(F.col(side_key).isNotNull()).groupBy(F.col(side_key).alias(f"__k{i}"))
        last = last.agg(F.max_by(F.struct(F.col(value).alias("v")), order).alias(f"__v{i}"))
        left = left.join(last, F.col(key) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
    hits = [F.col(f"__v{i}") for i in range(len(sides))]
    by = F.coalesce(*[F.when(h.isNotNull(), F.lit(sides[i][0])) for i, h in enumerate(hits)])
    return left.withColumn("matched_by", by).withColumn(out, F.coalesce(*hits)["v"]).drop(*[f"__v{i}" for i in range(len(sides))])


def label_join(docs: DataFrame, id_cols: list[str], labels: DataFrame, key: str, label: str, ord_col: str) -> DataFrame:
    """``docs`` with ``labels``: the sorted distinct labels of any of its ids, an empty array without one."""
    ids = docs.select(F.col(ord_col).alias("__o"), F.explode(F.array(*[F.col(c).cast("string") for c in id_cols])).alias("__id")).where("__id is not null")
    side = labels.select(F.col(key).cast("string").alias("__id"), F.col(label).alias("__l"))
    found = ids.join(side, "__id").groupBy("__o").agg(F.array_sort(F.collect_set("__l")).alias("labels"))
    return docs.join(found, F.col(ord_col) == F.col("__o"), "left").drop("__o").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))


def memo_split(rows: DataFrame, previous: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows done before with what ``previous`` has for them, rows to do), by null-safe equality of ``keys``."""
    once = previous.dropDuplicates(keys).select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in previous.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    drop = [f"__{k}" for k in keys]
    return rows.join(once, on).drop(*drop), rows.join(once.select(*drop), on, "left_anti")


def release_merge(previous: DataFrame, current: DataFrame, id_col: str, order: str) -> DataFrame:
    """All of ``previous``, then of ``current`` the first row of each id that is new. Null is one id."""
    seen = previous.select(F.col(id_col).alias("__id")).distinct()
    fresh = current.join(seen, F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
    first = fresh.withColumn("__n", F.row_number().over(Window.partitionBy(id_col).orderBy(order))).where("__n = 1").drop("__n")
    return previous.withColumn("origin", F.lit("previous")).unionByName(first.withColumn("origin", F.lit("current")), allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, key: str, source_key: str, column: str, value: Column) -> DataFrame:
    """``target`` with ``column`` replaced by ``value`` of ``source`` where the key is found; ``source`` has each key once."""
    side = source.select(F.col(source_key).alias("__k"), value.alias("__v"))
    out = target.join(side, F.col(key) == F.col("__k"), "left")
    return out.withColumn(column, F.coalesce("__v", column)).drop("__k", "__v")


def without_orphans(parents: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Parents that a child refers to."""
    return parents.join(children.select(F.col(child_key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left_semi")


def point_updates(docs: DataFrame, fixes: list[dict], keys: tuple[str, ...] = ("doi", "pubmed_id", "cord_uid")) -> DataFrame:
    """Field changes one after another; each names a document by its first key that is set, a field and a value."""
    for fix in fixes:
        key = next(k for k in keys if fix.get(k))
        docs = docs.withColumn(fix["field"], F.when(F.col(key) == fix[key], F.lit(fix["to"])).otherwise(F.col(fix["field"])))
    return docs
