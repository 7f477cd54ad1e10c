"""A log of changes to single documents, applied in order as one join and one fold a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.operators.components import connected_components
from lithos.session import staged


def applied(docs: DataFrame, fixes: DataFrame, keys: list[str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``docs`` with the fixes applied, the fixes that met no row).

    A fix is ``ord``, ``key`` (one of ``keys``), ``value``, ``field`` (one of ``fields``) and ``to``: in order of
    ``ord``, rows whose key has the value get ``to`` in the field. A field may be a key, so a fix can change what later
    ones name. Values are compared and written as text and cast to the field's type; a null ``to`` empties the field. ``ord`` tells all
    fixes apart; null keys and values meet nothing.

    Which fixes can reach a row is a matter of the fixes alone: a fix that rewrites a key ties its value to the new one, and
    the values tied together are one component. So a row is joined with the components of its keys, and folds their fixes in
    order. The plan does not depend on how many fixes there are.
    """
    fixes = staged(fixes.select("ord", "key", "value", "field", "to").where("key is not null and value is not null"), "fixes")
    node = lambda k, v: F.concat_ws("\x1f", k, v)
    ties = fixes.where(F.col("field").isin(*keys) & F.col("to").isNotNull())
    parts = connected_components(ties.select(node("key", "value").alias("src"), node("field", "to").alias("dst")))
    nodes = fixes.select(node("key", "value").alias("node")).union(ties.select(node("field", "to"))).distinct()
    parts = nodes.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("part"))
    mine = fixes.select(node("key", "value").alias("node"), F.struct("ord", "key", "value", "field", "to").alias("fix"))
    lists = mine.join(parts, "node").groupBy("part").agg(F.collect_list("fix").alias("fixes"))
    reach = staged(parts.join(lists, "part"), "reach").select("node", "part", "fixes")

    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    ids = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys])
    held = rows.select("__row", F.explode(F.filter(ids, lambda x: x["v"].isNotNull())).alias("id")).select("__row", node("id.k", "id.v").alias("node"))
    held = held.join(reach, "node").select("__row", "part", "fixes").dropDuplicates(["__row", "part"])
    own = held.groupBy("__row").agg(F.array_sort(F.flatten(F.collect_list("fixes"))).alias("__fixes"))
    state = F.struct(*[F.col(c).cast("string").alias(c) for c in dict.fromkeys([*keys, *fields])], F.array().cast("array<long>").alias("__used"))

    def step(acc: Column, fix: Column) -> Column:
        hit = F.lit(False)
        for k in keys:
            hit = hit | F.coalesce((fix["key"] == k) & (acc[k] == fix["value"]), F.lit(False))
        put = [F.when(hit & (fix["field"] == c), fix["to"]).otherwise(acc[c]).alias(c) for c in dict.fromkeys([*keys, *fields])]
        used = F.when(hit, F.concat(acc["__used"], F.array(fix["ord"].cast("long")))).otherwise(acc["__used"])
        return F.struct(*put, used.alias("__used"))

    done = rows.join(own, "__row").withColumn("__s", F.aggregate("__fixes", state, step))
    done = staged(done.select("__row", "__s"), "fixed")
    both = rows.join(done, "__row", "left")
    out = both.select(*[F.when(F.col("__s").isNotNull(), F.col(f"__s.{c}").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in fields or c in keys else F.col(c) for c in docs.columns])
    met = done.select(F.explode("__s.__used").alias("ord")).distinct()
    return out, fixes.join(met, "ord", "left_anti")
