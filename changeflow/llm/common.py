"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.paths import stage, unstage

__all__ = ["load", "stage", "unstage", "held_out", "fresh_name", "numbered", "release", "short_batches"]

# Rows of whole texts that an Arrow batch may hold.
TEXT_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches cut to TEXT_ROWS rows: texts are long, and a task holds a batch several
    times, in the JVM and in Python. A smaller setting of the session stays."""
    rows = int(df.sparkSession.conf.get(BATCH_ROWS))
    if not 0 < rows <= TEXT_ROWS:
        df.sparkSession.conf.set(BATCH_ROWS, TEXT_ROWS)
    return df


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether a row belongs to the held-out fold; a row without id counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(True))


def fresh_name(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't use yet (Spark compares names without regard to case)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def numbered() -> dict:
    """A dict that numbers its keys in the order of their first use."""
    index: dict = defaultdict()
    index.default_factory = index.__len__
    return index


def release() -> None:
    """Give the memory that Python and numpy have freed back to the system. Workers live on after a task, and what they
    keep adds up with the executor's own memory."""
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
