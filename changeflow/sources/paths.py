"""Directory helpers over the Hadoop file system API, and scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a directory; empty when it does not exist."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return [status.getPath().getName() for status in fs.listStatus(p)]


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=value`` directories directly under ``path``."""
    prefix = f"{column}="
    return [n[len(prefix):] for n in child_names(spark, path) if n.startswith(prefix)]


def make(spark: SparkSession, path: str) -> None:
    """Make sure that a directory is there."""
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def new_scratch(spark: SparkSession) -> str:
    """A fresh directory under the session's ``spark.checkpoint.dir``, which all executors share.

    A session without that setting gets it under its warehouse, which executors share as well; a temporary folder of one
    machine is never used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/.scratch"
    return f"{shared.rstrip('/')}/changeflow-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to scratch space and read it back.

    For a result that is used several times, such as a change set about to be merged: it is computed
    once, survives lost executors, and the planner knows its true size.
    """
    spark = df.sparkSession
    path = new_scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def size(stored: DataFrame) -> int:
    """Bytes of a stored frame's files."""
    spark = stored.sparkSession
    found = [_path(spark, folder) for folder in {file.rpartition("/")[0] for file in stored.inputFiles()}]
    return sum(fs.getContentSummary(p).getLength() for fs, p in found)


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a directory."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def unstage(staged: DataFrame) -> None:
    """Free the directory of a staged frame that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in staged.inputFiles()}:
        delete(staged.sparkSession, folder)
