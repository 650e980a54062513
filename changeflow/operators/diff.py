"""Change rows between two snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import DELETE, INSERT, UPDATE, as_list
from changeflow.sources.paths import stage


def snapshot_diff(before: DataFrame, after: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """INSERT, UPDATE and DELETE rows that lead from ``before`` to ``after``, counting repeated rows.

    Equal rows of both sides cancel out, one for one. Where exactly one old and one new row of a key are left, the new
    one is an UPDATE; otherwise every old row left is a DELETE, with the old row, and every new one an INSERT. So a
    repeated key loses no row, and the rows of ``before`` less those deleted and updated, plus those inserted and
    updated, are ``after``. NULL is a key like any other. Rows are counted by hash aggregation with partial results, so
    a hot key is reduced before the shuffle.
    """
    keys, columns = as_list(key), before.columns
    sided = before.withColumn("__n", F.lit(-1)).unionByName(after.withColumn("__n", F.lit(1)))
    left = stage(sided.groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n != 0"))
    single = left.groupBy(*keys).agg(F.count("*").alias("__c"), F.min("__n").alias("__lo"), F.max("__n").alias("__hi"))
    single = stage(single.where("__c = 2 AND __lo = -1 AND __hi = 1").select(*[F.col(k).alias(f"__{k}") for k in keys]))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    updated = left.where("__n = 1").join(single, same, "left_semi").withColumn("_operation", F.lit(UPDATE))
    other = left.join(single, same, "left_anti").withColumn("_operation", F.when(F.col("__n") > 0, INSERT).otherwise(DELETE))
    other = other.withColumn("__i", F.explode(F.sequence(F.lit(1), F.abs("__n")))).drop("__i")
    payload = [c for c in columns if c not in keys]
    return updated.unionByName(other).select(*keys, *payload, "_operation")
