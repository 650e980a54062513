"""Counts and profiles used to check a load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from changeflow.functions.columns import DELETE, INSERT, UPDATE, as_timestamp


def operation_counts(batch: DataFrame, by: Sequence[str] = (), op: str = "_operation") -> DataFrame:
    """Rows and INSERT / UPDATE / DELETE totals of a change batch."""
    return batch.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(op) == INSERT).alias("n_insert"),
        F.count_if(F.col(op) == UPDATE).alias("n_update"),
        F.count_if(F.col(op) == DELETE).alias("n_delete"),
    )


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per layer with its row count."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
              for name, df in layers.items()]
    whole = counts[0]
    for other in counts[1:]:
        whole = whole.union(other)
    return whole


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: NULLs, distinct estimate, and how many values read as a date.

    One aggregation over the data; it advises on key and date columns and decides nothing.
    """
    def facts(name: str, data_type) -> Column:
        column = F.col(f"`{name}`")
        dates = F.count(as_timestamp(column)) if isinstance(data_type, StringType) else F.lit(0).cast("bigint")
        return F.struct(
            F.lit(name).alias("column"),
            F.count("*").alias("n_rows"),
            F.count(column).alias("n_values"),
            F.approx_count_distinct(column).alias("approx_distinct"),
            dates.alias("n_dates"),
        )

    profiles = df.agg(F.array(*[facts(f.name, f.dataType) for f in df.schema.fields]).alias("p"))
    return (
        profiles.select(F.explode("p").alias("p"))
        .select("p.*")
        .withColumn("complete", F.col("n_values") == F.col("n_rows"))
        .withColumn("maybe_key", F.col("complete") & (F.col("approx_distinct") >= 0.9 * F.col("n_rows")))
        .withColumn("maybe_date", (F.col("n_values") > 0) & (F.col("n_dates") == F.col("n_values")))
        .drop("complete")
    )


def profile_part(df: DataFrame) -> DataFrame:
    """The facts of one landing, one row per column, in a form that can be merged: counts, and a sketch of the distinct values."""

    def facts(name: str, data_type) -> Column:
        column = F.col(f"`{name}`")
        text = isinstance(data_type, StringType)
        return F.struct(
            F.lit(name).alias("column"),
            F.count("*").alias("n_rows"),
            F.count(column).alias("n_values"),
            (F.count(as_timestamp(column)) if text else F.lit(0).cast("bigint")).alias("n_dates"),
            F.hll_sketch_agg(column if text else column.cast("string")).alias("sketch"),
        )

    parts = df.agg(F.array(*[facts(f.name, f.dataType) for f in df.schema.fields]).alias("p"))
    return parts.select(F.inline("p"))


def merged_profile(parts: DataFrame) -> DataFrame:
    """The profile of all landings together, from theirs: no landing is read again. A column may be the key if it is
    complete and its distinct values are about as many as the rows (the sketch is within a few percent)."""
    whole = parts.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.sum("n_dates").alias("n_dates"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
    )
    complete = F.col("n_values") == F.col("n_rows")
    return whole.withColumn("maybe_key", complete & (F.col("approx_distinct") >= 0.9 * F.col("n_rows"))).withColumn(
        "maybe_date", (F.col("n_values") > 0) & (F.col("n_dates") == F.col("n_values"))
    )
