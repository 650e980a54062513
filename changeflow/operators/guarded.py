"""Net effect of many change batches where a guard refuses changes older than what they meet.

Whether a change counts depends on the outcome of the ones before it, so a key's batch winners are folded in order. There is
one of them per batch: the list of a key is as long as there are batches at most, however hot the key, and the cut to one row
per key and batch comes before the shuffle. The fold is an expression; no rows leave the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import DELETE, INSERT, REPLACE, UPDATE, any_null, as_list
from changeflow.operators.latest import latest
from changeflow.operators.merge import REFERENCE, effective_op, merge
from changeflow.operators.replay import ACTION
from changeflow.sources.paths import stage


def guarded_changes(
    target: DataFrame,
    feed: DataFrame,
    key: str | Sequence[str],
    batch: str,
    order: str | Sequence[str],
    guard: str,
    op: str = "_operation",
    mode: str = REFERENCE,
    remember: bool = False,
    deleted: DataFrame | None = None,
) -> DataFrame:
    """One row per key, target columns and ``_action``, that equals merging all batches with ``guard`` one by one.

    A change is refused if its guard is less than that of the row it meets or, with ``remember``, of the key's last DELETE;
    ``deleted`` (key and guard columns) are DELETEs remembered from earlier. A change or row without a guard value is never
    refused and refuses nothing. With ``remember``, DELETE rows carry the guard to be remembered, also of absent keys.
    The target is scanned once, for keys and guards of the feed's keys.
    """
    keys, columns = as_list(key), target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    kind = types[guard]
    winners = latest(feed, [*keys, batch], order, op).where(F.col(op).isin(INSERT, UPDATE, DELETE))
    winners = stage(winners.select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys],
        F.struct(F.col(batch).isNotNull().alias("known"), F.col(batch).alias("batch")).alias("turn"),
        effective_op(F.col(op), mode).alias("act"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns]).alias("row"),
    ))
    keyed = winners.where(~any_null(keys))
    keyless = winners.where(any_null(keys) & (F.col("act") != DELETE)).select("row.*", F.lit(INSERT).alias(ACTION))
    stored = target.join(keyed.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max(guard).alias("high"))
    found = keyed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "act", "row"))).alias("turns"))
    found = found.join(stage(stored.withColumn("was", F.lit(True))), keys, "left")
    grave = F.lit(None).cast(kind)
    if deleted is not None:
        known = deleted.groupBy(*keys).agg(F.max(guard).alias("grave"))
        found, grave = found.join(known, keys, "left"), F.col("grave")

    def state(alive: Column, high: Column, dead: Column, row: Column, died: Column) -> Column:
        return F.struct(alive.alias("alive"), high.alias("high"), dead.alias("dead"), row.alias("row"), died.alias("died"))

    def step(s: Column, w: Column) -> Column:
        own = w["row"][guard]
        late = (s["alive"] & F.coalesce(own < s["high"], F.lit(False))) | F.coalesce(own < s["dead"], F.lit(False))
        goes = ~late & (w["act"] == DELETE)
        comes = ~late & ((w["act"] == UPDATE) | ((w["act"] == INSERT) & ~s["alive"]))
        dead = F.greatest(s["dead"], own) if remember else s["dead"]
        return state(
            F.when(goes, False).when(comes, True).otherwise(s["alive"]),
            F.when(comes, own).when(~goes, s["high"]),
            F.when(goes, dead).when(~comes, s["dead"]),
            F.when(comes, w["row"]).when(~goes, s["row"]),
            s["died"] | (goes & s["alive"]),
        )

    was = F.coalesce("was", F.lit(False))
    none = F.lit(None).cast(winners.schema["row"].dataType)
    found = found.withColumn("s", F.aggregate("turns", state(was, F.col("high"), grave, none, F.lit(False)), step))
    alive, row = F.col("s.alive"), F.col("s.row")
    gone = ~alive & (was | F.lit(remember) & F.col("s.dead").isNotNull())
    action = (
        F.when(gone, DELETE)
        .when(alive & row.isNotNull(), F.when(was & F.col("s.died"), REPLACE).when(was, UPDATE).otherwise(INSERT))
    )
    values = [F.col(c) if c in keys else F.when(gone, F.col("s.dead")).otherwise(row[c]) if c == guard else row[c] for c in columns]
    net = found.withColumn(ACTION, action).where(F.col(ACTION).isNotNull())
    return net.select(*[v.alias(c) for v, c in zip(values, columns)], ACTION).unionByName(keyless)


def replay_guarded(
    target: DataFrame,
    feed: DataFrame,
    key: str | Sequence[str],
    batch: str,
    order: str | Sequence[str],
    guard: str,
    op: str = "_operation",
    mode: str = REFERENCE,
    remember: bool = False,
) -> DataFrame:
    """The table after all batches of ``feed``, each merged with the guard."""
    net = stage(guarded_changes(target, feed, key, batch, order, guard, op, mode, remember))
    return merge(target, net, key, ACTION, mode)
