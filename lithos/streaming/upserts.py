"""A table kept by key, fed by a stream: each batch inserts new keys and updates known ones.

The table is a log: what a batch changes is a folder of its own, at most one row a key, so a batch costs what it
changes and not what is there. A batch that runs again, after a lost driver say, overwrites its own folder and decides by
the folders before it, so it does nothing twice. Every ``compact_every`` batches the table so far is written as one base.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lithos.session import _file_system


@dataclass(frozen=True)
class KeyedTable:
    """``folder`` holds ``changes/batch=n`` and ``base/upto=n``; of rows of one key the last by ``order`` counts, a later batch's among equals.

    A null key is one key. Columns named ``batch``, ``upto`` and ``action`` are the table's own.
    """

    spark: SparkSession
    folder: str
    key: str
    order: str
    compact_every: int = 16

    def _numbers(self, kind: str, name: str) -> list[int]:
        files, at = _file_system(self.spark, f"{self.folder}/{kind}")
        if not files.exists(at):
            return []
        found = [s.getPath() for s in files.listStatus(at)]
        whole = [p.getName() for p in found if files.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in whole if n.startswith(f"{name}="))

    def _last(self, rows: DataFrame, *columns: str) -> DataFrame:
        value = F.struct(*[F.col(c) for c in columns])
        return rows.groupBy(F.col(self.key).alias("__k")).agg(F.max_by(value, F.struct(self.order, "batch")).alias("__v")).select("__v.*")

    def _log(self, before: int | None = None) -> DataFrame | None:
        """Rows with their batch: the newest base that counts and the changes after it."""
        bases = [n for n in self._numbers("base", "upto") if before is None or n < before]
        batches = [n for n in self._numbers("changes", "batch") if (before is None or n < before) and (not bases or n > bases[-1])]
        parts = [self.spark.read.parquet(f"{self.folder}/base/upto={bases[-1]}").withColumn("batch", F.lit(bases[-1]).cast("long"))] if bases else []
        if batches:
            paths = [f"{self.folder}/changes/batch={n}" for n in batches]
            parts.append(self.spark.read.option("basePath", f"{self.folder}/changes").parquet(*paths).withColumn("batch", F.col("batch").cast("long")).drop("action"))
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None

    def read(self) -> DataFrame:
        """The rows as they are now; a table that got no batch raises."""
        log = self._log()
        if log is None:
            raise ValueError(f"no batch has reached {self.folder}")
        return self._last(log, *[c for c in log.columns if c != "batch"])

    def changes(self) -> DataFrame:
        """What the batches since the start did: ``batch`` and ``action``, "insert" or "update", beside the rows."""
        return self.spark.read.option("basePath", f"{self.folder}/changes").parquet(f"{self.folder}/changes")

    def merge(self, batch: DataFrame, number: int) -> None:
        """Batch ``number``, whole: a row whose key is known is an update if it is not older than what is there, else nothing."""
        last = self._last(batch.withColumn("batch", F.lit(number)), *batch.columns)
        log = self._log(number)
        if log is None:
            out = last.withColumn("action", F.lit("insert"))
        else:
            known = log.groupBy(F.col(self.key).alias("__k")).agg(F.max(self.order).alias("__o"))
            found = last.join(known, last[self.key].eqNullSafe(known["__k"]) & F.lit(True), "left").withColumn("__known", F.col("__o").isNotNull())
            out = found.where(~F.col("__known") | (F.col(self.order) >= F.col("__o")))
            out = out.withColumn("action", F.when(F.col("__known"), "update").otherwise("insert")).drop("__k", "__o", "__known")
        out.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={number}")
        if (number + 1) % self.compact_every == 0:
            self.read().write.mode("overwrite").parquet(f"{self.folder}/base/upto={number}")

    def drain(self, path: str, schema, files_per_batch: int = 1) -> None:
        """Takes all files under ``path`` that it has not taken yet, some at a time; call it again for new ones."""
        rows = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        run = rows.writeStream.foreachBatch(self.merge).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True)
        run.start().awaitTermination()


def known_split(rows: DataFrame, table: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """``rows`` with ``known``, the ``ident`` of the table's row that holds the first of their ``keys`` that any does, and ``action``.

    Empty and null keys are none. Where rows of the table share a key, the least ``ident`` stands for it.
    """
    hits = []
    for i, k in enumerate(keys):
        side = table.where(F.col(k) != "").groupBy(F.col(k).alias(f"__k{i}")).agg(F.min(ident).alias(f"__i{i}"))
        rows = rows.join(side, F.col(k) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        hits.append(f"__i{i}")
    return rows.withColumn("known", F.coalesce(*hits)).withColumn("action", F.when(F.col("known").isNull(), "insert").otherwise("update")).drop(*hits)


def admitted(rows: DataFrame, title: str, abstract: str, order: str, wanted: Column) -> DataFrame:
    """Rows that may be sampled: an abstract that is not empty, the first by ``order`` of their title, and ``wanted``.

    The title counts as seen by its first row with an abstract, wanted or not. Null titles are one title.
    """
    some = rows.where(F.col(abstract) != "")
    first = F.row_number().over(Window.partitionBy(title).orderBy(order))
    return some.withColumn("__n", first).where("__n = 1").drop("__n").where(wanted)
