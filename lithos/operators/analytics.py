"""Counts, shares, trends and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.operators.ranks import in_ranges, sums_before


def mode_per_group(rows: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each group; among equals the one seen first by ``order``."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def top_per_group(rows: DataFrame, group: str, k: int, order: list[Column]) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("__r") <= k).drop("__r")


def crosstab(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """``(a, b, n, total)`` with the total of each a."""
    counts = rows.groupBy(a.alias("a"), b.alias("b")).agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy("a")))


def dense_yearly(rows: DataFrame, key: str, year: Column) -> DataFrame:
    """``(key, year, n)`` for every key and year present, zero filled; both sides are small aggregates."""
    counts = rows.groupBy(key, year.alias("year")).agg(F.count("*").alias("n"))
    grid = counts.select(key).distinct().crossJoin(counts.select("year").distinct())
    return grid.join(counts, [key, "year"], "left").fillna(0, ["n"])


def year_differences(dense: DataFrame, key: str) -> DataFrame:
    """``(key, prev_year, prev, next, diff)`` of following years on a dense grid."""
    w = Window.partitionBy(key).orderBy("year")
    out = dense.withColumn("next", F.lead("n").over(w)).where("next is not null")
    return out.select(key, F.col("year").alias("prev_year"), F.col("n").alias("prev"), "next", (F.col("next") - F.col("n")).alias("diff"))


def rare_fold(rows: DataFrame, value: str, least: int, other: str = "Other") -> DataFrame:
    """Counts by value; values with fewer than ``least`` rows count as ``other``."""
    counts = rows.groupBy(value).agg(F.count("*").alias("n"))
    return counts.groupBy(F.when(F.col("n") < least, other).otherwise(F.col(value)).alias("bucket")).agg(F.sum("n").alias("n"))


def average_percentile(rows: DataFrame, value: str, out: str = "pct") -> DataFrame:
    """The percentile rank in (0, 1] with ties sharing their average rank.

    Counts by value are dealt out by ranges of values and summed inside each; what comes before a
    range is a sum over as many numbers as there are ranges. Rows without a value go.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("__v")).agg(F.count("*").alias("__n"))
    counts = in_ranges(counts, ["__v"])
    start, total = sums_before(counts, F.col("__n"))
    if start is None:
        return rows.where(F.lit(False)).withColumn(out, F.lit(None).cast("double"))
    inside = Window.partitionBy("__p").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    before = start + F.coalesce(F.sum("__n").over(inside), F.lit(0))
    ranked = counts.select("__v", ((before + (F.col("__n") + 1) / 2) / F.lit(total)).alias(out))
    return rows.join(ranked, F.col(value) == F.col("__v")).drop("__v")


def prf(rows: DataFrame, truth: str, predicted: str, label: str = "label") -> DataFrame:
    """Counts, precision, recall and F1 by label, pooled (MICRO) and averaged (MACRO); no denominator gives 0."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    sums = [F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn")]

    def scored(df: DataFrame) -> DataFrame:
        rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
        df = df.withColumn("p", rate(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("r", rate(F.col("tp"), F.col("tp") + F.col("fn")))
        return df.withColumn("f1", rate(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))

    each = scored(rows.groupBy(label).agg(*sums))
    micro = scored(rows.agg(F.lit("MICRO").alias(label), *sums))
    whole = [F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]
    macro = each.agg(F.lit("MACRO").alias(label), *whole, *[F.avg(c).alias(c) for c in ("p", "r", "f1")])
    return each.unionByName(micro).unionByName(macro)


def share_where(rows: DataFrame, test: Column) -> DataFrame:
    """``(n, total, percent)``: how many rows pass, of how many, rounded to one place."""
    counts = rows.agg(F.count_if(test).alias("n"), F.count("*").alias("total"))
    return counts.withColumn("percent", F.round(100 * F.try_divide("n", "total"), 1))


def monthly(rows: DataFrame, date: Column, *keys: str) -> DataFrame:
    """``(keys, month, n)`` with months as their first day; rows without a date go."""
    return rows.where(date.isNotNull()).groupBy(*keys, F.trunc(date, "month").alias("month")).agg(F.count("*").alias("n"))


def branch_trends(rows: DataFrame, branch: Column, topic: str, date: Column, k: int = 5) -> DataFrame:
    """``(branch, topic, month, n)`` of the ``k`` most frequent topics of each branch, the lesser name first among equals."""
    counts = monthly(rows.withColumn("branch", branch), date, "branch", topic)
    totals = counts.groupBy("branch", topic).agg(F.sum("n").alias("__t"))
    best = top_per_group(totals, "branch", k, [F.desc("__t"), F.col(topic)]).select("branch", topic)
    return counts.join(best, ["branch", topic])


def class_balance(rows: DataFrame, labels: list[str]) -> DataFrame:
    """``(label, value, n, percent)``: rows with each value of each label column, and their share of those that have one, to two places."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in labels])).alias("x")
    counts = rows.select(each).select("x.*").where("value is not null").groupBy("label", "value").agg(F.count("*").alias("n"))
    # a handful of rows: one for each value of each label
    return counts.withColumn("percent", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy("label")), 2))


def top_shares(rows: DataFrame, period: str, topics: str, k: int = 10) -> DataFrame:
    """``(period, topic, n, percent, total)`` of the ``k`` topics that most rows have over all periods, the lesser name first among equals.

    ``topics`` is an array, in which a repeat counts once; ``total`` counts rows of the period, with a topic or without, and a topic that a period
    lacks has 0. The grid is of ``k`` topics and the periods. Rows without a period go.
    """
    rows = rows.where(F.col(period).isNotNull())
    each = rows.select(F.col(period).alias("period"), F.explode(F.array_distinct(topics)).alias("topic")).groupBy("period", "topic").agg(F.count("*").alias("n"))
    best = each.where("topic is not null").groupBy("topic").agg(F.sum("n").alias("__t")).orderBy(F.desc("__t"), "topic").limit(k).select("topic")
    totals = rows.groupBy(F.col(period).alias("period")).agg(F.count("*").alias("total"))
    grid = totals.crossJoin(best)  # k rows a period
    out = grid.join(each, ["period", "topic"], "left").fillna(0, ["n"])
    return out.select("period", "topic", "n", F.round(100 * F.col("n") / F.col("total"), 2).alias("percent"), "total")


def top_by_overall(mentions: DataFrame, doc: str, group: str, kind: str, name: str, k: int = 15) -> DataFrame:
    """``(group, kind, name, n, overall)``: documents of each group with the ``k`` names of a kind that most documents have, the lesser name first among equals.

    A name counts once a document; ``overall`` counts documents of all groups, and a group without a name has 0.
    """
    once = mentions.select(doc, group, kind, name).distinct()
    overall = once.select(doc, kind, name).distinct().groupBy(kind, name).agg(F.count("*").alias("overall"))
    best = top_per_group(overall, kind, k, [F.desc("overall"), F.col(name)])
    grid = once.select(group).distinct().crossJoin(best)  # k names a kind and group
    counts = once.groupBy(group, kind, name).agg(F.count("*").alias("__n"))
    return grid.join(counts, [group, kind, name], "left").select(group, kind, name, F.coalesce("__n", F.lit(0)).alias("n"), "overall")


def rare_fold_by(rows: DataFrame, group: str, value: str, least: int, other: str = "Other") -> DataFrame:
    """``(group, bucket, n)``: counts by group and value, in which values with fewer than ``least`` rows in all are ``other``."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    counts = counts.withColumn("__all", F.sum("n").over(Window.partitionBy(value)))
    return counts.groupBy(group, F.when(F.col("__all") < least, other).otherwise(F.col(value)).alias("bucket")).agg(F.sum("n").alias("n"))


def concept_years(concepts: DataFrame, doc: str, year: str, excluded: str, placeholders: tuple[str, ...] = ("", "-", "None")) -> DataFrame:
    """``(year, type, id, n)`` over the distinct (type, id, text) of each document; one id in two spellings counts twice.

    One type is left out, as are null and placeholder ids.
    """
    kept = concepts.where((F.col("type") != excluded) & F.col("id").isNotNull() & ~F.col("id").isin(*placeholders))
    once = kept.select(doc, year, "type", "id", "text").distinct()
    return once.groupBy(F.col(year).alias("year"), "type", "id").agg(F.count("*").alias("n"))


def top_changes(rows: DataFrame, key: str, before: Column, after: Column, k: int = 8) -> DataFrame:
    """``(key, before, after, change)``: of each key its percentage of the rows of two periods, and the ``k`` largest rises, the lesser key first among equals."""
    counts = rows.groupBy(key).agg(F.count_if(before).alias("b"), F.count_if(after).alias("a"))
    totals = rows.agg(F.count_if(before).alias("__b"), F.count_if(after).alias("__a"))
    share = lambda n, of: F.round(100 * F.coalesce(F.try_divide(n, of), F.lit(0.0)), 6)
    out = counts.crossJoin(totals).select(key, share("b", "__b").alias("before"), share("a", "__a").alias("after"))  # totals are one row
    return out.withColumn("change", F.round(F.col("after") - F.col("before"), 6)).orderBy(F.desc("change"), key).limit(k)


def filled(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, n, total)``: rows in which a column is not null, and not empty if it is an array, of how many."""
    kinds = dict(rows.dtypes)
    some = lambda c: F.col(c).isNotNull() & ((F.size(c) > 0) if kinds[c].startswith("array") else F.lit(True))
    counts = rows.agg(F.count("*").alias("total"), *[F.count_if(some(c)).alias(f"__{i}") for i, c in enumerate(columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("n"), F.col("total").alias("total")) for i, c in enumerate(columns)])
    return counts.select(F.inline(each))
