"""Numbers in a global order, without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.session import staged


def in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` dealt out by ranges of ``order``, as a written table with the range in ``__p``."""
    return staged(rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranges")


def sums_before(ranged: DataFrame, weight: Column) -> tuple[Column | None, int]:
    """What ``weight`` sums to in all ranges before a row's, and in all. One number a shuffle partition comes to the driver."""
    total, starts = 0, []
    for p, n in sorted((r[0], r[1]) for r in ranged.groupBy("__p").agg(F.sum(weight)).collect()):
        starts += [F.lit(p), F.lit(total)]
        total += n
    return (F.create_map(*starts)[F.col("__p")] if starts else None), total


def numbered(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """``rows`` with their number from 1 in ``order``, whose columns tell all rows apart."""
    ranged = in_ranges(rows, order)
    before, _ = sums_before(ranged, F.lit(1))
    number = F.row_number().over(Window.partitionBy("__p").orderBy(*order)).cast("long")
    return ranged.withColumn(out, number if before is None else number + before).drop("__p")
