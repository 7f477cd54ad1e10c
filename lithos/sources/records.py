"""XML records of large files, read in byte ranges and written back as they stood.

Spark's line reader takes any string as the end of a line and finds the first whole line of a byte range by itself; with
a record's end tag for it, files are split like any text, whatever store they are in, and a record at the
edge of two ranges is read once. What is kept of a record is its bytes, so a filter can write it out unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """``(file, record)``: every element ``tag`` of the files, from its start tag to its end tag, as text.

    What stands around them (header, footer) is left out. Elements of that name must not hold each other, nor the end tag in
    a comment. Ranges are of ``spark.sql.files.maxPartitionBytes``.
    """
    end = f"</{tag}>"
    rows = spark.read.option("lineSep", end).text(path)
    at = F.regexp_instr("value", F.lit(rf"<{tag}[\s>/]"))
    start = F.when(at > 0, at)
    whole = F.concat(F.substring(F.col("value"), start, F.length("value")), F.lit(end))
    return rows.select(F.col("_metadata.file_name").alias("file"), whole.alias("record")).where("record is not null")


def write_records(records: DataFrame, path: str, header: str, footer: str, column: str = "record") -> None:
    """Records as files of text, each with a header before and a footer after; nulls are left out. Rows stay in the partitions they come in."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            if batch.num_rows:
                values = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(values if begun else [header, *values], pa.string())], ["value"])
                begun = True
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([footer])], ["value"])

    records.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).mapInArrow(framed, "value string").write.text(path)


def superseded(rows: DataFrame, key: str, file: str, order: str) -> DataFrame:
    """Rows of the newest file, by name, that holds their key: all of them, repeats too. ``first_file`` and ``first_order`` are the key's first place.

    A null key is one key. The newest file of a key is an aggregate with partial sums, so a key of many rows costs one row a task.
    """
    newest = rows.groupBy(F.col(key).alias("__k")).agg(F.max(file).alias("__f"), F.min(F.struct(F.col(file).alias("file"), F.col(order).alias("order"))).alias("__first"))
    out = rows.join(newest, rows[key].eqNullSafe(newest["__k"]) & (rows[file] == newest["__f"]))
    return out.withColumns({"first_file": F.col("__first.file"), "first_order": F.col("__first.order")}).drop("__k", "__f", "__first")


def first_of_key(rows: DataFrame, key: str, file: str, order: str, value: str) -> DataFrame:
    """``(key, value)`` with the value of the oldest file, by name, that holds the key, the last of that file's."""
    least = rows.groupBy(F.col(key)).agg(F.min(file).alias("__f"))
    old = rows.join(least.withColumnRenamed(key, "__k"), F.col(key).eqNullSafe(F.col("__k")) & (F.col(file) == F.col("__f")))
    return old.groupBy(key).agg(F.max_by(value, order).alias(value))
