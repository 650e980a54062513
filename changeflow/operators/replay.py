"""Net effect of many change batches in one pass.

Applying batches one after the other costs one pass over the table per batch. ``net_changes``
reduces the whole history to one operation per key, with the same result as the sequence, and the
table is then merged once.

Within a batch only the latest change of a key counts. Over the batches, let ``ld`` be the last
DELETE. The row is then the last UPDATE after ``ld`` if there is one; else the table's row if there
was no DELETE; else the first INSERT after ``ld`` (a later INSERT meets an existing row and is
ignored); else nothing.

Winners and fold need one shuffle and one sort by key. Skew: hashes of keys are counted first, and keys whose hash has more
than one in ``HEAVY`` of all rows take another way: their batch winners are shuffled by (key, batch) after a map-side cut to
one row per group, and the rest are aggregates with partial results, so no task holds the history of such a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.columns import DELETE, INSERT, REPLACE, UPDATE, any_null, as_list
from changeflow.operators.latest import latest
from changeflow.operators.merge import REFERENCE, effective_op, merge
from changeflow.sources.paths import stage

ACTION = "_action"
BUCKETS, HEAVY = 65_536, 1_000


def net_changes(
    feed: DataFrame,
    key: str | Sequence[str],
    batch: str,
    order: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
) -> DataFrame:
    """One row per key that equals applying all batches in ``batch`` order, a NULL batch first.

    What to do with the row is in ``_action``; the feed's own columns stay as they came.
    """
    keys = as_list(key)
    keyed = feed.where(~any_null(keys))
    heavy, rest = _heavy(keyed, keys)
    nets = []
    if heavy:
        often = keyed.where(_bucket(keys).isin(heavy))
        nets.append(_fold_heavy(_winners(often, keys, batch, order, op), keys, batch, op, mode))
    if rest:
        light = keyed.where(~_bucket(keys).isin(heavy)) if heavy else keyed
        nets.append(_fold(_winners(light.repartition(*keys), keys, batch, order, op), keys, batch, op, mode))
    # Rows without a key never match anything: every written one is a row of its own.
    keyless = _winners(feed.where(any_null(keys)), keys, batch, order, op).where(F.col(op).isin(INSERT, UPDATE))
    nets.append(keyless.withColumn(ACTION, F.lit(INSERT)))
    return reduce(DataFrame.unionByName, [net.select(*feed.columns, ACTION) for net in nets])


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _heavy(feed: DataFrame, keys: Sequence[str]) -> tuple[list[int], bool]:
    """Hashes of keys with more than one in ``HEAVY`` of all rows, fewer than ``HEAVY``; whether there are other rows."""
    counts = feed.groupBy(_bucket(keys).alias("bucket")).agg(F.count("*").alias("n"))
    # Of ``BUCKETS`` rows at most.
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy()))
    found = counts.where(F.col("n") * HEAVY > F.col("all")).collect()
    return [r.bucket for r in found], not found or sum(r.n for r in found) < found[0]["all"]


def _winners(feed: DataFrame, keys: Sequence[str], batch: str, order: str | Sequence[str], op: str) -> DataFrame:
    return latest(feed, [*keys, batch], order, op).where(F.col(op).isin(INSERT, UPDATE, DELETE))


def _fold(winners: DataFrame, keys: Sequence[str], batch: str, op: str, mode: str) -> DataFrame:
    """The winner that says what becomes of each key, with that in ``_action``: the last one, INSERTs left out
    that follow another INSERT or an UPDATE and so meet a row."""
    said = effective_op(F.col(op), mode)
    # Changes without a batch come before all others. One window does it all: they cost more than the sort.
    turns = Window.partitionBy(*keys).orderBy(F.col(batch).asc_nulls_first())
    upto = turns.rowsBetween(Window.unboundedPreceding, 0)
    whole = turns.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marks = winners.select(
        "*",
        said.alias("__op"),
        F.lag(said).over(turns).alias("__before"),
        F.lead(said).over(turns).alias("__after"),
        F.max(said == DELETE).over(upto).alias("__gone"),
        (F.count_if(said != INSERT).over(whole) - F.count_if(said != INSERT).over(upto)).alias("__later"),
    )
    # An INSERT counts if it comes first or right after a DELETE.
    counts = (F.col("__op") != INSERT) | F.col("__before").isNull() | (F.col("__before") == DELETE)
    # Where nothing but INSERTs follows, only the first of them can count, and only after a DELETE.
    last = marks.where(counts & (F.col("__later") == 0) & ((F.col("__op") != DELETE) | F.col("__after").isNull()))
    action = (
        F.when(F.col("__op") == DELETE, DELETE)
        .when(F.col("__gone"), REPLACE)
        .otherwise(F.col("__op"))
    )
    # Of a deleted row only the key is left.
    payload = [F.when(F.col(ACTION) != DELETE, F.col(c)).alias(c) for c in winners.columns if c not in keys]
    return last.withColumn(ACTION, action).select(*keys, *payload, ACTION)


def _fold_heavy(winners: DataFrame, keys: Sequence[str], batch: str, op: str, mode: str) -> DataFrame:
    """The same by aggregates."""
    payload = [c for c in winners.columns if c not in keys]
    winners = winners.withColumn(ACTION, effective_op(F.col(op), mode))
    row = F.struct(*[F.col(c) for c in payload])
    # Changes without a batch come before all others.
    turn = F.struct(F.col(batch).isNotNull(), F.col(batch))
    updated = F.when(F.col(ACTION) == UPDATE, turn)
    marks = winners.groupBy(*keys).agg(
        F.max(F.when(F.col(ACTION) == DELETE, turn)).alias("__ld"),
        F.max(updated).alias("__lu"),
        F.max_by(row, updated).alias("__update"),
    )
    # Is there an UPDATE after the last DELETE?
    marks = marks.withColumn("__alive", F.coalesce(F.col("__lu") > F.col("__ld"), F.col("__lu").isNotNull()))
    written = F.when(F.col("__alive"), F.col("__update"))
    if mode == REFERENCE:
        # Only keys without such an UPDATE need their first INSERT.
        open_keys = marks.where(~F.col("__alive")).select(*keys, "__ld")
        firsts = (
            winners.where(F.col(ACTION) == INSERT)
            .join(open_keys, keys, "inner")
            .where(F.col("__ld").isNull() | (turn > F.col("__ld")))
            .groupBy(*keys)
            .agg(F.min_by(row, turn).alias("__insert"))
        )
        marks = marks.join(firsts, keys, "left")
        written = written.otherwise(F.col("__insert"))

    action = (
        F.when(F.col("__row").isNull(), DELETE)
        .when(F.col("__ld").isNotNull(), REPLACE)
        .when(F.col("__alive"), UPDATE)
        .otherwise(INSERT)
    )
    return marks.withColumn("__row", written).select(*keys, "__row.*", action.alias(ACTION))


def replay(
    target: DataFrame,
    feed: DataFrame,
    key: str | Sequence[str],
    batch: str,
    order: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
) -> DataFrame:
    """The table after all batches of ``feed``; the feed is read once, the table is merged once."""
    return merge(target, stage(net_changes(feed, key, batch, order, op, mode)), key, ACTION, mode)
