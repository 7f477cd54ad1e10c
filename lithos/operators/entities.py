"""Results of knowledge-base and web look-ups, which come as JSON, as entities and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bindings(rows: DataFrame, json: str, order: str) -> DataFrame:
    """``(order, id, name, description, alias)`` of SPARQL result rows as JSON text, one binding each.

    The id is the last part of the entity's URL. Labels, descriptions and aliases count in English only; rows without an
    English label, and text that is no JSON, give none.
    """
    v = F.try_parse_json(json)

    def said(name: str) -> Column:
        lang = F.try_variant_get(v, f"$.{name}['xml:lang']", "string")
        return F.when(lang == "en", F.try_variant_get(v, f"$.{name}.value", "string"))

    out = rows.select(
        F.col(order).alias("order"),
        last_part(F.try_variant_get(v, "$.entity.value", "string")).alias("id"),
        said("entityLabel").alias("name"),
        said("entityDescription").alias("description"),
        said("alias").alias("alias"),
    )
    return out.where("id is not null and name is not null")


def last_part(url: Column) -> Column:
    """What follows the last slash of a URL, all of it without one."""
    return F.substring_index(url, "/", -1)


def folded(found: DataFrame) -> DataFrame:
    """One entity an id: ``id``, ``name``, ``description``, ``aliases``, from ``bindings``.

    The last name and the last description by ``order`` count, aliases accumulate, and the name is one. Aliases longer than three letters count,
    with and without the registered sign, trimmed and in lower case, without those with a slash, sorted, each once. Entities without an alias, or with
    a slash in their name, go. The fold is one aggregate with partial states, whatever the rows of an id.
    """
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("order"))).alias(c)
    out = found.groupBy("id").agg(last("name"), last("description"), F.collect_set("alias").alias("aliases"))
    every = F.filter(F.concat("aliases", F.array("name")), lambda a: F.length(a) > 3)
    every = F.concat(every, F.transform(every, lambda a: F.trim(F.replace(a, F.lit("®"), F.lit("")))))
    every = F.filter(F.transform(every, lambda a: F.lower(F.trim(a))), lambda a: ~a.contains("/"))
    out = out.select("id", "name", "description", F.array_sort(F.array_distinct(every)).alias("aliases"))
    return out.where((F.size("aliases") > 0) & ~F.col("name").contains("/"))


def lookup_url(base: str, ids: list[tuple[str, Column]]) -> Column:
    """Where to ask about a row: the first of (kind, id) that is not empty, as ``base/kind/id``; null if none is."""
    one = lambda kind, c: F.when(F.trim(c) != "", F.concat(F.lit(f"{base}/{kind}/"), F.trim(c)))
    return F.coalesce(*[one(kind, c) for kind, c in ids])


def response(text: Column, fields: dict[str, str]) -> Column:
    """A struct of ``ok`` and the ``fields`` (name: type) of a JSON response; an empty, broken or "Not Found" one is not ok."""
    v = F.when(F.trim(text) != "Not Found", F.try_parse_json(text))
    read = [F.try_variant_get(v, f"$.{name}", kind).alias(name) for name, kind in fields.items()]
    return F.struct(F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)).alias("ok"), *read)


# Fixed patterns: the address of an attention badge, and a point as longitude and latitude.
BADGE = r"^https://badges.altmetric.com/\?size=\d+&score=\d+&types=(\w+)$"
POINT = r"^Point\(([-+]?[0-9]*\.?[0-9]+) ([-+]?[0-9]*\.?[0-9]+)\)"


def attention(response: Column) -> Column:
    """A struct of the columns that a release holds of an attention record; the score of a week is that of a day, as its users expect.

    ``response`` has ``altmetric_id``, ``score``, ``history`` (a map), ``is_oa`` and ``images.large``, whose address names the badge; another address raises.
    """
    url = response["images"]["large"]
    fault = F.raise_error(F.concat(F.lit("not a badge: "), F.coalesce(url, F.lit("null")))).cast("string")
    kind = F.when(url.rlike(BADGE), F.regexp_extract(url, BADGE, 1)).otherwise(fault)
    day = response["history"]["1d"]
    parts = {"altmetric_id": response["altmetric_id"], "score": response["score"], "score_1day": day, "score_1week": day, "openaccess": response["is_oa"], "badgetype": kind}
    return F.when(response.isNotNull(), F.struct(*[v.alias(k) for k, v in parts.items()]))


def coordinates(point: Column) -> Column:
    """A struct (longitude, latitude) of "Point(lon lat)"; null for anything else."""
    part = lambda n: F.regexp_extract(point, POINT, n).try_cast("double")
    return F.when(point.rlike(POINT), F.struct(part(1).alias("longitude"), part(2).alias("latitude")))
