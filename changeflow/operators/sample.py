"""Repeatable samples of an exact size."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def _crossed(rows: DataFrame, value: Column, n: int) -> tuple[int, int]:
    """The least value up to which there are at least ``n`` rows, and how many rows have a lesser one. Values are few."""
    counts = sorted(tuple(r) for r in rows.groupBy(value.alias("v")).count().collect())
    before = [0, *accumulate(c for _, c in counts)]
    return next((v, b) for (v, c), b in zip(counts, before) if b + c >= n)


def exact_sample(
    rows: DataFrame, spread: Column, span: int, rate: float, ties: Sequence[str] | None = None, least: int = 1
) -> DataFrame:
    """The first ``int(rate * rows)`` rows, ``least`` at least, in the order of ``spread``, numbers of [0, ``span``) that deal
    the rows out evenly; rows of one number come in the order of ``ties``, by default all columns.

    A histogram of the numbers gives the bin in which the sample ends, one of that bin the number. All rows below it are
    in, and only the rows of that number are sorted. The driver sees histograms of at most BINS and span / BINS counts.
    NULL numbers count as 0. An empty table gives an empty sample; a smaller one than ``least`` is taken whole.
    """
    spread = F.coalesce(spread.cast("bigint"), F.lit(0))
    total = rows.count()
    n = min(total, max(least, int(rate * total)))
    if n <= 0:
        return rows.limit(0)
    width = -(-span // BINS)
    bin_, below = _crossed(rows, F.floor(spread / width), n)
    number, inside = _crossed(rows.where(F.floor(spread / width) == bin_), spread, n - below)
    last = rows.where(spread == number).orderBy(*[F.col(c).asc_nulls_first() for c in ties or rows.columns])
    return rows.where(spread < number).unionByName(last.limit(n - below - inside))
