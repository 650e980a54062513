"""Incremental extraction: which rows of a source were handed out, and which come next.

The emitted keys aren't made distinct before a join: repeated ones don't change it, and a join with an aggregate can't split a
hot key of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "_key"


def key_set(rows: DataFrame, key: str) -> DataFrame:
    """Distinct keys as text, the form in which emitted keys are remembered."""
    return rows.select(F.col(key).cast("string").alias(KEY)).distinct()


def remember(path: str, batch: DataFrame, key: str) -> None:
    """Add the keys of a batch to the key memory, a parquet directory; nothing is read back for it."""
    key_set(batch, key).write.mode("append").parquet(path)


def pending_rows(rows: DataFrame, emitted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the emitted ones. The emitted keys may repeat."""
    keys = emitted.select(KEY)
    return rows.join(keys, F.col(key).cast("string") == keys[KEY], "left_anti")


def emitted_rows(rows: DataFrame, emitted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the emitted ones, which may repeat."""
    keys = emitted.select(KEY)
    return rows.join(keys, F.col(key).cast("string") == keys[KEY], "left_semi")


def next_batch(rows: DataFrame, emitted: DataFrame, key: str, order: Sequence[str], size: int) -> DataFrame:
    """The first ``size`` pending rows in ``order``, NULLs last; each task keeps only its top rows."""
    sort = [F.col(c).asc_nulls_last() for c in order]
    return pending_rows(rows, emitted, key).orderBy(*sort).limit(size)


def extend_key_set(emitted: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Emitted keys together with those of a new batch."""
    return emitted.union(key_set(batch, key)).distinct()


def union_change_sets(*sets: DataFrame) -> DataFrame:
    """Change sets with differing columns, one below the other; absent columns are NULL."""
    whole = sets[0]
    for other in sets[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    return whole
