"""Order-free digests of rows by range, to find where two tables differ without joining them.

A range's digest is its number of rows and two sums of 64-bit row hashes (one plain, one by exclusive or), so equal bags of
rows have equal digests in any order and with any partitioning. Digests are partial aggregates: a table is read once and
shuffles one row per task and range. Different bags have equal digests with a chance of about 2 ** -128.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import as_list
from changeflow.operators.diff import snapshot_diff
from changeflow.sources.paths import stage

RANGE = "_range"


def digests(rows: DataFrame, by: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """(``_range``, n_rows, total, parity) over ``columns``, by default all."""
    columns = columns or rows.columns
    one, other = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    # Halves are added, so that no sum leaves a bigint below 2 ** 31 rows a range.
    low, high = one.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright(one, 32)
    return rows.groupBy(by.alias(RANGE)).agg(
        F.count("*").alias("n_rows"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.bit_xor(other).alias("parity")
    )


def added_up(parts: DataFrame) -> DataFrame:
    """The digests of several bags of rows together, from those of each."""
    sums = [F.sum(c).alias(c) for c in ("n_rows", "low", "high")]
    return parts.groupBy(RANGE).agg(*sums, F.bit_xor("parity").alias("parity"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per range of either side's digests: rows before, rows after, and whether both hold the same rows."""
    facts = ["n_rows", "low", "high", "parity"]
    b = b.select(F.col(RANGE).alias("__range"), *[F.col(c).alias(f"__{c}") for c in facts])
    both = a.join(b, F.col(RANGE).eqNullSafe(F.col("__range")), "full")
    same = F.lit(True)
    for c in facts:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    # A range without a row on one side has NULL facts there, its number included.
    return both.select(
        F.when(F.col("n_rows").isNull(), F.col("__range")).otherwise(F.col(RANGE)).alias(RANGE),
        F.coalesce("n_rows", F.lit(0)).alias("n_before"),
        F.coalesce("__n_rows", F.lit(0)).alias("n_after"),
        same.alias("same"),
    )


def compared(before: DataFrame, after: DataFrame, by: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """``differences`` of two tables."""
    return differences(digests(before, by, columns), digests(after, by, columns))


def hashed_range(key: str | Sequence[str], ranges: int) -> Column:
    return F.pmod(F.xxhash64(*as_list(key)), F.lit(ranges)).cast("int")


def digest_diff(before: DataFrame, after: DataFrame, key: str | Sequence[str], ranges: int = 4096) -> DataFrame:
    """The result of ``snapshot_diff``, in which only rows of ranges that differ are grouped and joined. Where little has
    changed, the snapshots are read twice and next to nothing is shuffled."""
    by = hashed_range(key, ranges)
    other = stage(compared(before, after, by, before.columns).where("NOT same").select(RANGE))
    small = F.broadcast(other)  # at most ``ranges`` rows

    def touched(rows: DataFrame) -> DataFrame:
        return rows.withColumn(RANGE, by).join(small, RANGE, "left_semi").drop(RANGE)

    return snapshot_diff(touched(before), touched(after.select(*before.columns)), key)
