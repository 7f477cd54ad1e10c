"""Connected components of an edge table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.session import discard, staged


def _pointed(pairs: DataFrame) -> DataFrame:
    """Each neighbour ``v`` of ``u`` with ``m``, the least of ``u`` and its neighbours.

    The minimum is an aggregate with partial sums, so a node with very many
    neighbours costs one row per map task; the join back may be split by AQE.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "least"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for each node on an edge; component = least reachable node.

    Alternates large-star and small-star steps (Kiveris et al., SoCC 2014) until the
    edge set stops changing; every round is written to the shared folder. Edges with a
    null end and self-loops are dropped, repeated edges count once; no edges give no rows.
    """
    a, b = F.col(src), F.col(dst)
    pairs = staged(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pointed(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = _pointed(large)  # here u > v always
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        last, pairs = pairs, staged(small.where("u != v").distinct(), "edges")
        discard(last)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
