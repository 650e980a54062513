"""Row changes of a projection, from the row changes of its source.

The old images of a change tell what the projection held, so its own changes follow from the feed
alone; neither table is read. The projection may rename the key but must keep it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, DELETE, INSERT, UPDATE, any_null, as_list
from changeflow.operators.latest import latest_row_changes
from changeflow.operators.merge import NEW_IMAGES
from changeflow.sources.paths import stage

UPDATES = ("update_preimage", "update_postimage")

def derived_changes(
    changes: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str | Column],
    where: Column | None = None,
    one_commit: bool = False,
) -> DataFrame:
    """Net row changes of ``select columns where ...`` over the source commits in ``changes``.

    Those of ``one_commit`` without a filter are simply projected. Otherwise:

    Per key, the projection held what the old images of the key's first commit pass the filter, and
    holds what the new images of its last commit do. A key is joined back to its own aggregates, so
    rows of a frequent key are never gathered in one task.
    """
    if one_commit and where is None:
        return changes.select(*columns, CHANGE_TYPE)
    keys = as_list(key)
    kept = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    is_new = F.col(CHANGE_TYPE).isin(*NEW_IMAGES)
    ends = _ends(changes, keys).where(kept)
    ends = stage(ends)
    sides = stage(ends.groupBy(*keys).agg(F.max(~F.col("__new")).alias("__had"), F.max(F.col("__new")).alias("__has")))
    kind = (
        F.when(F.col("__new"), F.when(F.col("__had"), "update_postimage").otherwise("insert"))
        .when(F.col("__has"), "update_preimage")
        .otherwise("delete")
    )
    labelled = ends.join(sides, keys, "inner").select(*columns, kind.alias(CHANGE_TYPE))
    # Rows without a key are only ever inserted.
    keyless = changes.where(any_null(keys) & is_new).where(kept)
    return labelled.unionByName(keyless.select(*columns, F.lit("insert").alias(CHANGE_TYPE)))


def _ends(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key the old images of its first commit and the new images (``__new``) of its last one."""
    keyed = changes.where(~any_null(keys))
    # The aggregates are stored: a join with one that isn't can't split a hot key.
    span = stage(keyed.groupBy(*keys).agg(F.min(COMMIT_VERSION).alias("__first"), F.max(COMMIT_VERSION).alias("__last")))
    new = F.col(CHANGE_TYPE).isin(*NEW_IMAGES)
    return (
        keyed.join(span, keys, "inner")
        .withColumn("__new", new)
        .where(F.when(F.col("__new"), F.col(COMMIT_VERSION) == F.col("__last"))
               .otherwise(F.col(COMMIT_VERSION) == F.col("__first")))
    )


def changes_by_query(
    changes: DataFrame, key: str | Sequence[str], query: str, out_key: str | Sequence[str], one_commit: bool = False
) -> DataFrame:
    """Net row changes of a projection given as SQL text over ``{source}``, such as ``SELECT a AS id, b FROM {source} WHERE c``.

    The text runs as it is, once on the old and once on the new images. It takes each row by itself (no aggregates, no
    DISTINCT) and keeps the key as ``out_key``, which tells where a row was, is, or both. Of ``one_commit``, inserts and
    deletes are what they are, and so are updates that all pass the text's filter; nothing is shuffled then.
    """
    keys, out = as_list(key), as_list(out_key)
    spark = changes.sparkSession
    columns = [c for c in changes.columns if c not in (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)]

    def images(rows: DataFrame, which: Column | str) -> DataFrame:
        return spark.sql(query, source=rows.where(which).select(*columns))

    # Rows without a key are only ever inserted.
    keyless = changes.where(any_null(keys) & F.col(CHANGE_TYPE).isin(*NEW_IMAGES))
    keyless = images(keyless, F.lit(True)).withColumn(CHANGE_TYPE, F.lit("insert"))
    if not one_commit:
        ends = stage(_ends(changes, keys).select(*columns, "__new"))
        return _paired(images(ends, "NOT __new"), images(ends, "__new"), out).unionByName(keyless)
    keyed = changes.where(~any_null(keys))
    kinds = {kind: images(keyed, F.col(CHANGE_TYPE) == kind) for kind in ("delete", "insert", *UPDATES)}
    labelled = {kind: rows.withColumn(CHANGE_TYPE, F.lit(kind)) for kind, rows in kinds.items()}
    pairs = [labelled.pop(kind) for kind in UPDATES]
    came = [_imprint(keyed.where(F.col(CHANGE_TYPE) == kind), keys) for kind in UPDATES]
    if came != [_imprint(kinds[kind], out) for kind in UPDATES]:
        pairs = [_paired(*[kinds[kind] for kind in UPDATES], out)]
    return reduce(DataFrame.unionByName, [*labelled.values(), *pairs, keyless])


def _imprint(rows: DataFrame, keys: Sequence[str]) -> tuple:
    """Tells whether two frames hold the same keys, each as often."""
    spread = F.pmod(F.xxhash64(*keys), F.lit(1 << 20))
    return tuple(rows.agg(F.count("*"), F.sum(spread), F.sum(F.pmod(F.xxhash64(F.lit(1), *keys), F.lit(1 << 20)))).first())


def _paired(old: DataFrame, new: DataFrame, out: Sequence[str]) -> DataFrame:
    """Old and new images of a projection as its row changes, by the keys that both have."""
    old, new = stage(old), stage(new)
    marks = [df.select(*out).withColumn("__met", F.lit(True)) for df in (new, old)]
    marks = [stage(m.groupBy(*out).agg(F.max("__met").alias("__met"))) for m in marks]
    gone = F.when(F.col("__met"), "update_preimage").otherwise("delete")
    come = F.when(F.col("__met"), "update_postimage").otherwise("insert")
    labelled = [df.join(m, out, "left").select(*df.columns, kind.alias(CHANGE_TYPE)) for df, m, kind in ((old, marks[0], gone), (new, marks[1], come))]
    return labelled[0].unionByName(labelled[1])


def projected_operations(
    changes: DataFrame, columns: Sequence[str | Column], where: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Row changes, pre-images left out, as projected rows with the operation to merge; one that fails the filter is a
    DELETE. ``keep`` are columns of the changes to keep beside the projection."""
    kept = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    operation = (
        F.when((F.col(CHANGE_TYPE) == "delete") | ~kept, DELETE)
        .when(F.col(CHANGE_TYPE) == "insert", INSERT)
        .otherwise(UPDATE)
    )
    images = changes.where(F.col(CHANGE_TYPE) != "update_preimage")
    return images.withColumn("_operation", operation).select(*columns, "_operation", *keep)


def latest_operations(
    changes: DataFrame, key: str | Sequence[str], columns: Sequence[str | Column], where: Column | None = None
) -> DataFrame:
    """One projected row per key, that of its latest row change, with the operation to merge."""
    return projected_operations(latest_row_changes(changes, key), columns, where)
