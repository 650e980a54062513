"""Distinct values of a column, or of several together, once and kept current.

A value leaves the set when its last row goes. Keeping the number of rows per value makes that a
matter of adding up the row changes (+1 for new images, -1 for old ones), whatever the size of the
table the values come from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_VERSION, DELETE, UPDATE, any_null, as_list
from changeflow.operators.merge import ACT, ADDED, NEW_IMAGES, OLD

ROWS = "_rows"


def distinct_values(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Distinct values without NULLs; of several columns, those rows in which all are there."""
    names = as_list(column)
    return df.where(~any_null(names)).select(*names).distinct()


def value_counts(df: DataFrame, column: str | Sequence[str]) -> DataFrame:
    names = as_list(column)
    return df.where(~any_null(names)).groupBy(*names).agg(F.count("*").alias(ROWS))


def value_deltas(changes: DataFrame, column: str | Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Change of each value's row count, or of its count per ``by``; values whose count is unchanged are left out."""
    names = as_list(column)
    sign = F.when(F.col(CHANGE_TYPE).isin(*NEW_IMAGES), 1).otherwise(-1)
    return (
        changes.where(~any_null(names))
        .groupBy(*names, *by)
        .agg(F.sum(sign).cast("bigint").alias("__delta"))
        .where("__delta <> 0")
    )


def set_history(before: DataFrame, changes: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """The values that entered or left the set, version by version, from the row changes of all versions together.

    ``before`` is the table that the changes start from. A value's count runs over the versions that touch it, one row
    each after partial aggregation.
    """
    names = as_list(column)
    start = value_counts(before, names).withColumnRenamed(ROWS, "__delta").withColumn(COMMIT_VERSION, F.lit(None).cast("bigint"))
    deltas = start.unionByName(value_deltas(changes, names, [COMMIT_VERSION]))
    upto = Window.partitionBy(*names).orderBy(F.col(COMMIT_VERSION).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    running = deltas.withColumn("__now", F.sum("__delta").over(upto)).where(F.col(COMMIT_VERSION).isNotNull())
    was = F.col("__now") - F.col("__delta")
    kind = F.when((was <= 0) & (F.col("__now") > 0), "insert").when((was > 0) & (F.col("__now") <= 0), "delete")
    return running.select(*names, kind.alias(CHANGE_TYPE), COMMIT_VERSION).where(F.col(CHANGE_TYPE).isNotNull())


def count_row_changes(counts: DataFrame, deltas: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """Row changes that bring ``counts`` (those of the values in ``deltas``) up to date."""
    before, after = F.col(ROWS), F.coalesce(F.col(ROWS), F.lit(0)) + F.col("__delta")

    def image(kind: str, rows: Column) -> Column:
        return F.struct(F.lit(kind).alias(CHANGE_TYPE), rows.cast("bigint").alias("n"))

    images = (
        F.when(before.isNull(), F.array(image("insert", after)))
        .when(after <= 0, F.array(image("delete", before)))
        .otherwise(F.array(image("update_preimage", before), image("update_postimage", after)))
    )
    return (
        deltas.join(counts, as_list(column), "left")
        .select(*as_list(column), F.explode(images).alias("image"))
        .select(*as_list(column), F.col("image.n").alias(ROWS), f"image.{CHANGE_TYPE}")
    )


def classify_counts(counts: DataFrame, deltas: DataFrame, column: str | Sequence[str]) -> DataFrame:
    """The same, and the values whose count stays, by one full outer join, in the form of ``merge.classify_all``; ``counts``
    may have more columns. Both sides have a value once, so there is no frequent one."""
    names, more = as_list(column), [c for c in counts.columns if c not in (*as_list(column), ROWS)]
    before, delta = F.col(ROWS), F.col("__delta")
    after = F.coalesce(before, F.lit(0)) + delta
    act = (
        F.when(delta.isNull(), F.lit(None))
        .when(before.isNull(), ADDED)
        .when(after <= 0, DELETE)
        .otherwise(UPDATE)
    )
    seen = counts.join(deltas, names, "full").withColumn(ACT, act)
    return seen.select(
        *names,
        F.when(F.col(ACT).isin(ADDED, UPDATE), after).otherwise(before).cast("bigint").alias(ROWS),
        *more,
        ACT,
        F.when(F.col(ACT).isin(DELETE, UPDATE), F.struct(*names, ROWS)).alias(OLD),
    )


def set_changes(count_row_changes: DataFrame) -> DataFrame:
    """Values that really entered or left the set, from the row changes of the counts."""
    return count_row_changes.where(F.col(CHANGE_TYPE).isin("insert", "delete")).drop(ROWS)
