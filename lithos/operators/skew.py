"""Joins onto keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.session import staged

#: At most so many keys are broadcast, those with more than one in so many of all rows each.
HEAVY = 2000


def join_counted(rows: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``counts`` by ``key``, where ``counts`` has in ``n`` how many of the rows hold a key.

    A key with more than a ``HEAVY``-th part of the counted rows is joined by broadcast, of which
    there are fewer than ``HEAVY`` whatever the rows, so no task gets a hot key's rows. The others are merged.
    ``discard`` of the result, when it has been used up, deletes the written counts.
    """
    counts = staged(counts, "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * HEAVY > total
    few = F.broadcast(counts.where(hot))
    light = rows.join(F.broadcast(counts.where(hot).select(key)), key, "left_anti")
    out = light.join(counts.where(~hot).hint("merge"), key).unionByName(rows.join(few, key))
    out.staged_at = counts.staged_at
    return out
