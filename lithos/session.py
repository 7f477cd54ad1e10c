"""Sessions, the shared folder for intermediate tables, and table reading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see: ``spark.checkpoint.dir``.

    Where the setting is absent, a local master gets a temporary folder of its own;
    any other master raises, since executors would not share such a folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"file://{tempfile.mkdtemp(prefix='lithos-')}"
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: what follows survives the loss of executors without
    recomputing what came before.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, folder = _file_system(spark, path)
    files.deleteOnExit(folder)
    return path


def discard(df: DataFrame) -> None:
    """Delete what ``staged`` wrote, once nothing reads it any more."""
    path = getattr(df, "staged_at", None)
    if path:
        files, folder = _file_system(df.sparkSession, path)
        files.delete(folder, True)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
