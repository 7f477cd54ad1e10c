"""The star schema of a release: documents, entity types, entities, annotations, coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lithos.functions.dates import epoch_noon
from lithos.operators.ranks import numbered


def star_tables(release: DataFrame, main_type: str = "Virus") -> dict[str, DataFrame]:
    """Five tables from (ord, ..., entities array<struct<type, normalized, id, start, end, section>>).

    Ids follow first appearance. Facts come from documents that mention ``main_type`` only,
    counts of documents from all of them.
    """
    every = release.select("ord", F.posexplode("entities").alias("pos", "e")).select("ord", "pos", "e.*")
    seen = every.groupBy("type", F.col("normalized").alias("name")).agg(
        F.min(F.struct("ord", "pos")).alias("first"), F.count_distinct("ord").alias("doc_count"), F.min("id").alias("external_id")
    )
    kinds = seen.groupBy("type").agg(F.min("first").alias("first"))
    kinds = kinds.select(F.row_number().over(Window.orderBy("first")).alias("entitytype_id"), "type")
    entities = seen.join(F.broadcast(kinds), "type")  # one row for each type of a fixed list
    entities = numbered(entities, ["first", "type", "name"], "entity_id").select("entity_id", "entitytype_id", "type", "name", "external_id", "doc_count")
    main = every.where(F.col("type") == main_type).select("ord").distinct()
    facts = every.join(main, "ord", "left_semi").withColumnRenamed("normalized", "name")
    facts = facts.join(entities.select("type", "name", "entity_id"), ["type", "name"]).select(F.col("ord").alias("document_id"), "entity_id").distinct()
    scalar = [c for c, t in release.dtypes if not t.startswith(("array", "map", "struct")) and c != "ord"]
    documents = release.select(F.col("ord").alias("document_id"), *scalar, epoch_noon(F.col("publish_year"), F.col("publish_month"), F.col("publish_day")).alias("publish_timestamp"), mentions_json().alias("annotations_json"))
    return {"documents": documents, "entitytypes": kinds, "entities": entities, "annotations": facts}


def mentions_json(column: str = "entities"):
    """Mentions as JSON text, sorted by type and name, with their places."""
    part = lambda e: F.struct(e["type"].alias("type"), e["normalized"].alias("name"), e["section"].alias("section"), e["start"].alias("start"), e["end"].alias("end"))
    return F.to_json(F.array_sort(F.transform(column, part)))


def coordinates(entities: DataFrame, terms: DataFrame, type_name: str = "Location") -> DataFrame:
    """Longitude and latitude of the entities of one type that the dictionary knows."""
    places = terms.select(F.col("id").alias("external_id"), "longitude", "latitude").where("longitude is not null").dropDuplicates(["external_id"])
    return entities.where(F.col("type") == type_name).join(places, "external_id").select("entity_id", "longitude", "latitude")


def write_jdbc(tables: dict[str, DataFrame], url: str, properties: dict, batch: int = 1000) -> None:
    """Each table to a relational database, in batches."""
    for name, df in tables.items():
        df.write.option("batchsize", batch).jdbc(url, name, mode="overwrite", properties=properties)
