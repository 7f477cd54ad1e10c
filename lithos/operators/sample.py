"""Samples of fixed size by hash: the same rows whatever the partitions, without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(key: str, seed: str = "") -> Column:
    """A row's place in the order of a sample: the MD5 of its key as text, after the seed if there is one; a null key counts as empty."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), text) if seed else text)


def bottom(rows: DataFrame, key: str, k: int, stratum: str | None = None, seed: str = "") -> DataFrame:
    """The ``k`` rows whose keys have the least hashes, of all or of each value of ``stratum`` (null is one); ties go by the key.

    Without strata each task keeps ``k`` rows and one merges them. With strata a first pass keeps ``k`` of each in every task's
    share (hashes deal a stratum out to 64 shares), so a stratum of any size sends few rows on.
    """
    if stratum is None:
        return rows.withColumn("__h", ranked(key, seed)).orderBy("__h", key).limit(k).drop("__h")
    rows = rows.withColumn("__h", ranked(key, seed)).withColumn("__s", F.substring("__h", 31, 2))
    for by in ([stratum, "__s"], [stratum]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("__h", key))
        rows = rows.withColumn("__r", place).where(F.col("__r") <= k).drop("__r")
    return rows.drop("__h", "__s")
