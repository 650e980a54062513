"""Latest change per key.

The filter ``rn = 1`` sits directly on ``row_number()``, so Spark plans a partial
``WindowGroupLimit`` in front of the shuffle: every map task sends at most one row per key. A key
that owns a third of the feed therefore costs one row per map task, not one giant group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_VERSION, any_null, as_list, op_rank


def latest(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    op: str | None = None,
) -> DataFrame:
    """One row per key: the highest in ``order``, NULLs lowest.

    Ties go to the stronger operation (when ``op`` is given) and then to the remaining columns in
    schema order, so the order is total and a retried task picks the same row.
    """
    keys, order = as_list(key), as_list(order)
    sort = [F.col(c).desc_nulls_last() for c in order]
    if op is not None:
        sort.append(op_rank(F.col(op)).desc())
    sort += [F.col(c).desc_nulls_last() for c in df.columns if c not in {*keys, *order}]
    window = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def latest_row_changes(changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Last row change per key, pre-images left out, ordered by commit version.

    Rows without a key have no identity: each insert of one is kept.
    """
    keys = as_list(key)
    images = changes.where(F.col(CHANGE_TYPE) != "update_preimage")
    keyed = latest(images.where(~any_null(keys)), keys, COMMIT_VERSION)
    return keyed.unionByName(images.where(any_null(keys) & (F.col(CHANGE_TYPE) == "insert")))
