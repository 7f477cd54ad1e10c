"""Incremental runs: a file stream drained with AvailableNow, merged batch by batch.

The stream's checkpoint replaces a list of processed files. Each batch writes its partial
result under its own number and overwrites it if the batch runs again, so a lost executor or
a restart counts nothing twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.session import shared_dir


def drain_counts(spark: SparkSession, path: str, schema, keys: list[str], state: str | None = None, files_per_batch: int = 1) -> DataFrame:
    """Row counts by ``keys`` of all files seen so far under ``path``; call again with the same ``state`` to add new files."""
    state = state or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def merge(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(F.count("*").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{state}/parts/batch={number}")

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    run = rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{state}/parts").groupBy(*keys).agg(F.sum("n").alias("n"))


def windowed_counts(stream: DataFrame, ts: str, window: str, late: str, *keys: str) -> DataFrame:
    """Counts by event-time window and keys, for rows at most ``late`` behind the newest."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window), *keys).agg(F.count("*").alias("n"))


def upsert(previous: DataFrame, batch: DataFrame, key: str, order: Column) -> DataFrame:
    """One row a key: the last of both by ``order``; a row of ``batch`` beats an equal one."""
    both = previous.withColumn("__b", F.lit(0)).unionByName(batch.withColumn("__b", F.lit(1)))
    value = F.struct(*[F.col(c) for c in previous.columns])
    return both.groupBy(F.col(key).alias("__k")).agg(F.max_by(value, F.struct(order, "__b")).alias("__v")).select("__v.*")


def remaining(ids: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """What has not been processed before."""
    return ids.join(processed.select(key).distinct(), key, "left_anti")
