"""Row changes of many change batches, batch by batch, in one pass.

``replay`` gives the table after all batches. Here every batch's own row changes are wanted, as if each had been merged into
the table that the batches before it left. What a change finds follows from its key's earlier changes since the last DELETE:
the last UPDATE, else the table's row (before the first DELETE), else the first INSERT.

Skew: batch winners are cut to one row per key and batch before the shuffle, so a window holds at most as many rows of a key
as there are batches, however hot the key. The table is read once and reduced to the keys of the feed before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_VERSION, DELETE, INSERT, UPDATE, any_null, as_list
from changeflow.operators.latest import latest
from changeflow.operators.merge import REFERENCE, effective_op
from changeflow.sources.paths import stage


def history(
    target: DataFrame,
    feed: DataFrame,
    key: str | Sequence[str],
    batch: str,
    order: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
) -> DataFrame:
    """Target columns, ``_change_type`` and ``_commit_version``, the number of the batch that made the change.

    The feed has all columns of the target. Batches are applied in the order of their numbers, changes without a number
    first; theirs have no version either. Each row of a key stored several times has its own images.
    """
    keys, columns = as_list(key), target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    winners = latest(feed, [*keys, batch], order, op).where(F.col(op).isin(INSERT, UPDATE, DELETE))
    winners = winners.select(
        *[F.col(k).cast(types[k]).alias(f"__{k}") for k in keys],
        F.col(batch).cast("bigint").alias("__batch"),
        effective_op(F.col(op), mode).alias("__op"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns]).alias("__row"),
    )
    own = [f"__{k}" for k in keys]
    keyless = winners.where(any_null(own) & (F.col("__op") != DELETE))
    keyless = keyless.select("__row.*", F.lit("insert").alias(CHANGE_TYPE), F.col("__batch").alias(COMMIT_VERSION))

    earlier = (Window.unboundedPreceding, -1)
    life = Window.partitionBy(*own).orderBy("__batch").rowsBetween(*earlier)
    since = Window.partitionBy(*own, "__deaths").orderBy("__batch").rowsBetween(*earlier)
    died = F.coalesce(F.sum((F.col("__op") == DELETE).cast("int")).over(life), F.lit(0))
    found = stage(
        winners.where(~any_null(own))
        .withColumn("__deaths", died)
        .withColumn("__updated", F.last(F.when(F.col("__op") == UPDATE, F.col("__row")), True).over(since))
        .withColumn("__inserted", F.first(F.when(F.col("__op") == INSERT, F.col("__row")), True).over(since))
    )
    # Only what changes need of the table is shuffled: rows of their keys.
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    stored = target.join(found.where("__deaths = 0").select(*own), same, "left_semi")
    stored = stored.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.struct(*columns).alias("__stored"))
    matched = F.col("__deaths") == 0
    for k in keys:
        matched = matched & (F.col(f"__{k}") == F.col(f"__key_{k}"))
    found = found.join(stored, matched, "left")
    old = F.coalesce("__updated", "__stored", "__inserted")

    def image(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    images = (
        F.when(old.isNull(), F.when(F.col("__op") != DELETE, F.array(image("insert", F.col("__row")))))
        .when(F.col("__op") == DELETE, F.array(image("delete", old)))
        .when(F.col("__op") == UPDATE, F.array(image("update_preimage", old), image("update_postimage", F.col("__row"))))
    )
    changes = found.select("__batch", F.explode(images).alias("image"))
    changes = changes.select("image.row.*", F.col("image.kind").alias(CHANGE_TYPE), F.col("__batch").alias(COMMIT_VERSION))
    return changes.unionByName(keyless)
