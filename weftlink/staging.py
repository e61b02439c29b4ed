"""Intermediate tables in the shared folder (``spark.checkpoint.dir``)."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a cluster
    without it is refused, as a machine-local folder would lose rows there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="weftlink-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def open_store(uri: str):
    """(file system, path) of a URI or a local path, for tasks that write or read files of
    their own in the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/weftlink/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> str:
    """The folder of the shared folder that a table was written to, as Parquet."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and gives Catalyst the exact size for its join choice."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df, name))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written`` made, once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of tables that nothing refers to any more; it learns
    of them when both sides collect their garbage."""
    gc.collect()
    spark._jvm.System.gc()
