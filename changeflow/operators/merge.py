"""Keyed merge of a change set into a table.

Outcome per key, in ``reference`` mode:

    operation        row exists            row absent
    INSERT           kept unchanged        inserted
    UPDATE           all columns replaced  inserted
    DELETE           removed               nothing
    NULL or other    kept unchanged        nothing

A NULL key never matches. ``latest_wins`` mode treats INSERT like UPDATE.

The change set holds one row per key and is usually far smaller than the table, so the table is
always the streamed side: left, inner and semi joins against the change set. When Spark's size
statistics put the change set under ``spark.sql.autoBroadcastJoinThreshold`` the table is not
shuffled at all; above it, the sort-merge join splits a hot table key on the table side, which a
full outer join could not do (``classify_all`` is one, for tables without such a key).

The change set is read more than once here; pass one that is stored (``sources.paths.stage``) unless
it is cheap to compute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import (
    CHANGE_TYPE,
    COMMIT_VERSION,
    DELETE,
    INSERT,
    REPLACE,
    UPDATE,
    any_null,
    as_list,
)
from changeflow.sources.paths import stage

REFERENCE, LATEST_WINS = "reference", "latest_wins"
NEW_IMAGES = ("insert", "update_postimage")
# Columns of classified rows: the operation that met a row, and the row before.
ACT, OLD = "__act", "__old"
ADDED = "__added__"


def effective_op(op: Column, mode: str) -> Column:
    if mode == REFERENCE:
        return op
    if mode == LATEST_WINS:
        return F.when(op == INSERT, UPDATE).otherwise(op)
    raise ValueError(f"unknown merge mode {mode!r}")


def _source_side(source: DataFrame, columns: Sequence[str], op: str, mode: str) -> DataFrame:
    return source.select(
        *[F.col(c).alias(f"__new_{c}") for c in columns],
        effective_op(F.col(op), mode).alias("__op"),
    )


def _on(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) == F.col(f"__new_{k}") for k in keys]


def present_keys(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys of the change set that the table holds: at most one row per change."""
    keys = as_list(key)
    return target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()


def drop_older(target: DataFrame, source: DataFrame, key: str | Sequence[str], guard: str) -> DataFrame:
    """Source rows that are not older, by column ``guard``, than any row stored under their key."""
    keys = as_list(key)
    stored = (
        target.join(source.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.max(guard).alias("__stored"))
    )
    older = F.coalesce(F.col(guard) < F.col("__stored"), F.lit(False))
    return source.join(stored, keys, "left").where(~older).drop("__stored")


def _new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], op: str) -> DataFrame:
    """Source rows that enter the table as rows of their own; ``__hit`` tells if the key existed."""
    writes = source.where(F.col(op).isin(INSERT, UPDATE, REPLACE))
    return _with_hits(present_keys(target, writes, keys), source, keys, op)


def _with_hits(present: DataFrame, source: DataFrame, keys: Sequence[str], op: str) -> DataFrame:
    writes = source.where(F.col(op).isin(INSERT, UPDATE, REPLACE))
    hit = present.withColumn("__hit", F.lit(True))
    return writes.join(hit, list(keys), "left").where(F.col("__hit").isNull() | (F.col(op) == REPLACE))


def merge(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
    guard: str | None = None,
) -> DataFrame:
    """The table after applying ``source`` (one row per key, all target columns plus ``op``).

    ``guard`` names an order column; a change lower than its stored row is then ignored.
    """
    keys, columns = as_list(key), target.columns
    if guard is not None:
        source = drop_older(target, source, keys, guard)
    src = _source_side(source, columns, op, mode)

    def acts(*ops: str) -> Column:
        return F.coalesce(F.col("__op").isin(*ops), F.lit(False))

    kept = (
        target.join(src, _on(keys), "left")
        .where(~acts(DELETE, REPLACE))
        .select(*[F.when(acts(UPDATE), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    )
    return kept.unionByName(_new_rows(target, source, keys, op).select(*columns))


def row_changes(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
    guard: str | None = None,
) -> DataFrame:
    """The row changes the same merge makes: target columns plus ``_change_type``.

    The target is scanned once; the rows that an operation met are stored, about as many as the change set has.
    """
    keys, columns = as_list(key), target.columns
    if guard is not None:
        source = drop_older(target, source, keys, guard)
    seen = stage(classify(target, source, keys, op, mode).where(F.col(ACT).isNotNull()))
    return classified_changes(seen, new_rows(seen, source, keys, op), columns)


def classify(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of the target once, in one scan: its columns as the merge leaves them, ``__act``, the operation that met it
    (NULL where none did), and ``__old``, the row before. ``columns`` are those of the change set; the target may have more,
    which stay. With ``classified_changes``, ``new_rows`` and ``stays``, state and row changes follow from the stored result.
    """
    keys, columns = as_list(key), columns or target.columns
    src = _source_side(source, columns, op, mode).where(F.col("__op").isin(INSERT, UPDATE, DELETE, REPLACE))
    more = [c for c in target.columns if c not in columns]
    replaced = F.col("__op") == UPDATE
    return target.join(src, _on(keys), "left").select(
        *[F.when(replaced, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        *more,
        F.col("__op").alias(ACT),
        F.when(F.col("__op").isin(UPDATE, DELETE, REPLACE), F.struct(*columns)).alias(OLD),
    )


def classify_all(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    op: str = "_operation",
    mode: str = REFERENCE,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``classify`` together with the rows of the change set that enter under keys the table lacks, which have ``ADDED`` as
    ``__act``. One full outer join, which can't split a frequent key: only for tables that have none. Source rows without a
    key are left out, and those of a REPLACE that met a row: ``replacing_rows`` has both.
    """
    keys, columns = as_list(key), columns or target.columns
    src = _source_side(source.where(~any_null(keys)), columns, op, mode)
    src = src.where(F.col("__op").isin(INSERT, UPDATE, DELETE, REPLACE))
    more = [c for c in target.columns if c not in columns]
    added = F.col(keys[0]).isNull()
    taken = added | (F.col("__op") == UPDATE)
    # Rows without a key match nothing and would all come to one task.
    keyless = target.where(any_null(keys)).select(
        *columns, *more, F.lit(None).cast("string").alias(ACT), F.when(F.lit(False), F.struct(*columns)).alias(OLD)
    )
    return target.where(~any_null(keys)).join(src, _on(keys), "full").where(~(added & (F.col("__op") == DELETE))).select(
        *[F.when(taken, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        *more,
        F.when(added, F.lit(ADDED)).otherwise(F.col("__op")).alias(ACT),
        F.when(~added & F.col("__op").isin(UPDATE, DELETE, REPLACE), F.struct(*columns)).alias(OLD),
    ).unionByName(keyless)


def replacing_rows(seen: DataFrame, source: DataFrame, key: str | Sequence[str], op: str = "_operation") -> DataFrame:
    """The source rows that ``classify_all`` leaves out, as ``new_rows`` gives them."""
    keys = as_list(key)
    met = seen.where(F.col(ACT) == REPLACE).select(*keys)
    back = source.where(F.col(op) == REPLACE).join(met, keys, "left_semi").withColumn("__hit", F.lit(True))
    keyless = source.where(any_null(keys) & F.col(op).isin(INSERT, UPDATE, REPLACE))
    return back.unionByName(keyless.withColumn("__hit", F.lit(None).cast("boolean")))


def stays() -> Column:
    """Whether a classified row is still in the table."""
    return F.col(ACT).isNull() | ~F.col(ACT).isin(DELETE, REPLACE)


def new_rows(matched: DataFrame, source: DataFrame, key: str | Sequence[str], op: str = "_operation") -> DataFrame:
    """Source rows that enter the table as rows of their own, ``__hit`` telling if the key existed; ``matched`` holds the
    classified rows that an operation met."""
    return _with_hits(matched.select(*as_list(key)).distinct(), source, as_list(key), op)


def classified_changes(seen: DataFrame, added: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """The row changes of a merge, from its classified and its new rows, if it has others than those classified as such."""

    def image(kind: str, row: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), row.alias("row"))

    pre = image("update_preimage", F.col(OLD))
    images = (
        F.when(F.col(ACT) == DELETE, F.array(image("delete", F.col(OLD))))
        .when(F.col(ACT) == UPDATE, F.array(pre, image("update_postimage", F.struct(*columns))))
        .when(F.col(ACT) == ADDED, F.array(image("insert", F.struct(*columns))))
        .otherwise(F.array(pre))
    )
    matched = seen.where(F.col(ACT).isin(UPDATE, DELETE, REPLACE, ADDED)).select(F.explode(images).alias("image"))
    matched = matched.select(*[F.col(f"image.row.{c}").alias(c) for c in columns], F.col("image.kind").alias(CHANGE_TYPE))
    if added is None:
        return matched
    kind = F.when(F.col("__hit"), "update_postimage").otherwise("insert")
    return matched.unionByName(added.select(*columns, kind.alias(CHANGE_TYPE)))


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str | Sequence[str], one_commit: bool = False
) -> DataFrame:
    """The table after the stored row changes of one or more commits.

    A commit replaces all rows of a key it touches, so a touched key consists of the new images of its
    last commit. Rows without a key are only ever added. Pre-images come with a post-image of the same
    key and commit, and are left out. ``one_commit`` says that every commit is a key's last.
    """
    keys, columns = as_list(key), target.columns
    changes = changes.where(F.col(CHANGE_TYPE) != "update_preimage")
    images = changes.where(F.col(CHANGE_TYPE).isin(*NEW_IMAGES))
    if one_commit:
        touched = changes.select(*keys)
        current = images.select(*columns)
    else:
        # Stored, so that a join with the aggregate can split a hot key.
        last = stage(changes.where(~any_null(keys)).groupBy(*keys).agg(F.max(COMMIT_VERSION).alias(COMMIT_VERSION)))
        touched = last.select(*keys)
        current = images.join(last, [*keys, COMMIT_VERSION], "left_semi").select(*columns)
        current = current.unionByName(images.where(any_null(keys)).select(*columns))
    return target.join(touched, keys, "left_anti").select(*columns).unionByName(current)
