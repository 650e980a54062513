"""A keyed table whose commits cost what they touch: rows partitioned by a hash of the key, in plain parquet.

    <path>/meta/                         one row with the schema; its arrival makes the table exist
    <path>/rows/_part=P/                 the rows now
    <path>/changes/_commit_version=N/    row changes of batch N
    <path>/next/                         what batch N makes of the partitions it touches, until they are replaced
    <path>/commits/_commit_version=N/    one row, the last thing that batch N writes; only the newest few stay

A batch reads and rewrites the partitions that hold its keys, through ``partitionOverwriteMode=dynamic``; a batch without
effect leaves nothing. What it makes of them is stored in full before the first one is replaced, so a batch that died at any
step is done again with the same outcome. There is one writer per table, and rows are read between its batches.

Rows without a key match nothing; they are spread by all their columns. Rewriting rebalances large partitions over tasks, and
the table is the streamed side of the joins, with one exception: a change set of a good part of the table's size, and a table
of even partitions, which has no frequent key, meet in one full outer join. The driver holds numbers of partitions only.

With a guard, ``keep_deleted`` keeps a tombstone for each deleted key: a row of the key and the guard's value. A change older
than it is ignored, so that a late UPDATE doesn't bring a deleted row back. The condition, on the guard's column, says which
tombstones stay; they are looked through whenever their partition is rewritten.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, DELETE, INSERT, REPLACE, UPDATE, any_null, as_list
from changeflow.operators.merge import (
    ACT,
    NEW_IMAGES,
    REFERENCE,
    classify,
    classify_all,
    classified_changes,
    drop_older,
    new_rows,
    replacing_rows,
    stays,
)
from changeflow.sources import paths

PART, GRAVE = "_part", "_grave"
MARKERS = 16
LARGE = 8  # a change set of one part in so many of the table's size touches all of it
COUNTS = {"n_insert": "insert", "n_update": "update_postimage", "n_delete": "delete"}
MARKER = ", ".join(["committed_at timestamp", "source_version bigint", *[f"{n} bigint" for n in COUNTS]])


class PartitionedTable:
    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], partitions: int = 256):
        """``partitions`` is used when the table is first written; the table keeps it."""
        self.spark, self.path, self.key, self._partitions = spark, path.rstrip("/"), as_list(key), partitions
        self._meta: Row | None = None

    # -- reading ----------------------------------------------------------------------------

    def exists(self) -> bool:
        return any(name.startswith("part-") for name in paths.child_names(self.spark, f"{self.path}/meta"))

    def meta(self) -> Row:
        if self._meta is None:
            if not self.exists():
                raise FileNotFoundError(f"no keyed table at {self.path}")
            schema = "schema string, partitions int, source_version bigint"
            self._meta = self.spark.read.schema(schema).parquet(f"{self.path}/meta").first()
        return self._meta

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self.meta().schema))

    def version(self) -> int | None:
        """The newest batch that was committed, 0 for the bootstrap, None where there is no table."""
        root = f"{self.path}/commits"
        for version in sorted(map(int, paths.partition_values(self.spark, root, COMMIT_VERSION)), reverse=True):
            if any(n.startswith("part-") for n in paths.child_names(self.spark, f"{root}/{COMMIT_VERSION}={version}")):
                return version
        return 0 if self.exists() else None

    def commit_row(self) -> Row:
        """What the newest commit says of itself."""
        version = self.version()
        if not version:
            return self.meta()
        return self.spark.read.schema(MARKER).parquet(f"{self.path}/commits/{COMMIT_VERSION}={version}").first()

    def _rows(self, parts: list[int] | None = None) -> DataFrame:
        schema = self.schema().add(GRAVE, "boolean").add(PART, "integer")
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        return rows if parts is None else rows.where(F.col(PART).isin(parts))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows now; a ``version`` must be the newest."""
        if version is not None and version != self.version():
            raise ValueError(f"{self.path} holds version {self.version()} only, not {version}")
        return self._rows().where(~F.col(GRAVE)).drop(GRAVE, PART)

    def register(self, name: str) -> None:
        self.read().createOrReplaceTempView(name)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The rows that have one of the given keys; only their partitions are read."""
        keys = keys.select(*[F.col(k).cast(self.schema()[k].dataType) for k in self.key])
        found = self._rows(self._touched(keys.where(~any_null(self.key)))).where(~F.col(GRAVE))
        return found.drop(GRAVE, PART).join(keys, self.key, "left_semi")

    def read_deleted(self) -> DataFrame:
        """The tombstones: rows of which only the key and the guard have values."""
        return self._rows().where(F.col(GRAVE)).drop(GRAVE, PART)

    def read_changes(self, first: int, last: int | None = None) -> DataFrame:
        """Row changes of batches ``first`` to ``last`` (default: the newest). Batches without effect have none."""
        newest = self.version()
        last = newest if last is None else last
        if last > newest or first > newest + 1:
            raise ValueError(f"{self.path}: versions {first} to {last} asked for, {newest} is the newest")
        schema = self.schema().add(CHANGE_TYPE, "string").add(COMMIT_VERSION, "long").add(COMMIT_TIMESTAMP, "timestamp")
        root = f"{self.path}/changes"
        folders = [f"{root}/{COMMIT_VERSION}={v}" for v in range(max(first, 1), last + 1)]
        folders = [f for f in folders if paths.exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.names)

    def stream_commits(self, commits_per_trigger: int | None = None) -> DataFrame:
        """Commits as a stream, which tells that there are new ones."""
        reader = self.spark.readStream.schema(f"committed_at timestamp, {COMMIT_VERSION} bigint")
        reader = reader.option("maxFileAge", "36500d").option("ignoreMissingFiles", "true")
        if commits_per_trigger:
            reader = reader.option("maxFilesPerTrigger", commits_per_trigger)
        paths.make(self.spark, f"{self.path}/commits")
        return reader.parquet(f"{self.path}/commits")

    # -- writing ----------------------------------------------------------------------------

    def _part(self, columns: Sequence[str] | None = None) -> Column:
        spread = F.xxhash64(*self.key)
        if columns is not None:
            spread = F.when(any_null(self.key), F.xxhash64(*columns)).otherwise(spread)
        return F.pmod(spread, F.lit(self.meta().partitions if self.exists() else self._partitions)).cast("int")

    def _touched(self, rows: DataFrame, columns: Sequence[str] | None = None) -> list[int]:
        """Numbers of the partitions that hold the rows; the table's number of partitions bounds the list."""
        return sorted(r[0] for r in rows.select(self._part(columns)).distinct().collect())

    def is_large(self, rows: DataFrame) -> bool:
        """Whether stored rows of distinct keys are so many, next to the table's, that they surely touch all partitions."""
        return LARGE * paths.size(rows) >= paths.folder_size(self.spark, f"{self.path}/rows")

    def _is_even(self, rows: DataFrame) -> bool:
        """Whether no partition has more than 1.25 times the rows of the mean, as a frequent key would make one of many. Only
        numbers of rows are read."""
        counts = [r["count"] for r in rows.groupBy(PART).count().collect()]
        return len(counts) >= 16 and max(counts) * len(counts) <= 1.25 * sum(counts)

    def _write(self, rows: DataFrame, mode: str) -> None:
        writer = rows.hint("rebalance", PART).write.partitionBy(PART).mode("overwrite")
        writer.option("partitionOverwriteMode", mode).parquet(f"{self.path}/rows")

    def overwrite(self, df: DataFrame, source_version: int | None = None) -> None:
        """Store ``df`` as the whole of a new table."""
        if self.exists():
            raise ValueError(f"{self.path} holds a table already")
        self._write(df.withColumn(GRAVE, F.lit(False)).withColumn(PART, self._part(df.columns)), "static")
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(df.schema.json()).alias("schema"),
            F.lit(self._partitions).alias("partitions"),
            F.lit(source_version).cast("bigint").alias("source_version"),
        )
        row.write.mode("overwrite").parquet(f"{self.path}/meta")

    def is_done(self, version: int) -> bool:
        return self.version() >= version

    def merge(
        self,
        version: int,
        source: DataFrame,
        op: str = "_operation",
        mode: str = REFERENCE,
        guard: str | None = None,
        source_version: int | None = None,
        keep_deleted: str | None = None,
        guarded: bool = False,
        unique: bool = False,
    ) -> None:
        """Merge a change set, one row per key, as batch ``version``; a done batch is left alone. The partitions it touches
        are scanned once (twice with a guard, which has to know the newest stored value first). ``guarded`` says that the
        guard has sorted out older changes already, ``unique`` that no key is repeated, which else is checked."""
        if self.is_done(version):
            return
        if not self._is_ready(version):
            columns = self.schema().names
            fields = [F.col(f.name).cast(f.dataType) for f in self.schema().fields]
            scratch = []

            def kept(df: DataFrame) -> DataFrame:
                scratch.append(paths.stage(df))
                return scratch[-1]

            # A cast can make keys equal.
            unique = unique and all(source.schema[k].dataType == self.schema()[k].dataType for k in self.key)
            source = kept(source.select(*fields, *([op] if op not in columns else [])))
            repeated = source.where(~any_null(self.key)).groupBy(*self.key).count().where("count > 1")
            repeated = None if unique else repeated.first()
            if repeated is not None:
                raise ValueError(f"{self.path}: the change set has {repeated['count']} rows for one key: {repeated}")
            large = self.is_large(source)
            stored = self._rows(None if large else self._touched(source.where(F.col(op).isNotNull()), columns))
            if guard is not None and not guarded:
                known = stored if keep_deleted is not None else stored.where(~F.col(GRAVE))
                source = kept(drop_older(known, source, self.key, guard))
            live = stored.where(~F.col(GRAVE)).select(*columns, PART)
            whole = large and self._is_even(live)
            seen = (classify_all if whole else classify)(live, source, self.key, op, mode, columns)
            seen = self._keep_seen(version, seen)
            if whole:
                added = kept(replacing_rows(seen, source, self.key, op))
            else:
                added = kept(new_rows(seen.where(F.col(ACT).isNotNull()), source, self.key, op))
            changes = classified_changes(seen, added, columns)
            rows = added.select(*columns, F.lit(False).alias(GRAVE), self._part(columns).alias(PART))
            if guard is not None and keep_deleted is not None:
                rows = rows.unionByName(self._graves(stored.where(F.col(GRAVE)), source, op, guard, keep_deleted))
            else:
                rows = rows.unionByName(stored.where(F.col(GRAVE)))
            # A change set of the table's size makes changes enough for the files of all the tasks that read the table.
            self._keep_changes(version, changes if large else changes.hint("rebalance"))
            self._store(version, rows)
            for staged in scratch:
                paths.unstage(staged)
        self._publish(version, source_version)

    def commit(self, version: int, changes: DataFrame, source_version: int | None = None) -> None:
        """Store row changes (table columns and ``_change_type``) and what they make of the partitions they touch."""
        if self.is_done(version):
            return
        if not self._is_ready(version):
            columns = self.schema().names
            fields = [F.col(f.name).cast(f.dataType) for f in self.schema().fields]
            changes = self._keep_changes(version, changes.select(*fields, CHANGE_TYPE))
            images = changes.where(F.col(CHANGE_TYPE).isin(*NEW_IMAGES))
            stored = self._rows(None if self.is_large(changes) else self._touched(changes, columns))
            touched = changes.where(~any_null(self.key)).select(*self.key)
            left = stored.where(~F.col(GRAVE)).join(touched, self.key, "left_anti").select(*columns, PART)
            left = left.withColumn(ACT, F.lit(None).cast("string"))
            left.write.mode("overwrite").parquet(self._next(version, "rows"))
            rows = images.select(*columns, F.lit(False).alias(GRAVE), self._part(columns).alias(PART))
            self._store(version, rows.unionByName(stored.where(F.col(GRAVE))))
        self._publish(version, source_version)

    def commit_all(
        self, version: int, classified: Callable[[DataFrame], DataFrame], source_version: int | None = None
    ) -> None:
        """A batch that may touch every row: ``classified`` takes the rows, with their partition as one more column, and
        gives them in the form of ``merge.classify_all``."""
        if self.is_done(version):
            return
        if not self._is_ready(version):
            columns, stored = self.schema().names, self._rows()
            seen = self._keep_seen(version, classified(stored.where(~F.col(GRAVE)).select(*columns, PART)))
            self._keep_changes(version, classified_changes(seen, None, columns))
            self._store(version, stored.where(F.col(GRAVE)))
        self._publish(version, source_version)

    def _keep_seen(self, version: int, seen: DataFrame) -> DataFrame:
        """Store classified rows, those that enter with the partition they belong to, and read them back."""
        seen = seen.withColumn(PART, F.coalesce(PART, self._part(self.schema().names)))
        seen.write.mode("overwrite").parquet(self._next(version, "rows"))
        return self.spark.read.schema(seen.schema).parquet(self._next(version, "rows"))

    def _graves(self, old: DataFrame, source: DataFrame, op: str, guard: str, keep_deleted: str) -> DataFrame:
        """The tombstones after a batch: old ones and those of its DELETEs, without the keys it writes."""
        dead = source.where(F.col(op) == DELETE).where(~any_null(self.key)).where(F.col(guard).isNotNull())
        every = old.select(*self.key, guard).unionByName(dead.select(*self.key, guard))
        every = every.groupBy(*self.key).agg(F.max(guard).alias(guard))
        written = source.where(F.col(op).isin(INSERT, UPDATE, REPLACE)).where(~any_null(self.key))
        every = every.join(written.select(*self.key), self.key, "left_anti").where(keep_deleted)
        fields = [
            (F.col(f.name) if f.name in {*self.key, guard} else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema().fields
        ]
        return every.select(*fields, F.lit(True).alias(GRAVE), self._part().alias(PART))

    def _next(self, version: int, name: str) -> str:
        return f"{self.path}/next/{COMMIT_VERSION}={version}/{name}"

    def _is_ready(self, version: int) -> bool:
        """Whether all that the batch makes is stored; from then on partitions may have been replaced."""
        return paths.exists(self.spark, f"{self._next(version, 'added')}/_SUCCESS")

    def _keep_changes(self, version: int, changes: DataFrame) -> DataFrame:
        """Store the row changes of a batch and read them back; nobody else reads them before the batch is committed."""
        folder = f"{self.path}/changes/{COMMIT_VERSION}={version}"
        changes.withColumn(COMMIT_TIMESTAMP, F.current_timestamp()).write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(self.schema().add(CHANGE_TYPE, "string")).parquet(folder)

    def _store(self, version: int, added: DataFrame) -> None:
        """The last thing to be stored before partitions are replaced."""
        added.write.mode("overwrite").parquet(self._next(version, "added"))

    def _publish(self, version: int, source_version: int | None) -> None:
        columns = self.schema().names
        folder = f"{self.path}/changes/{COMMIT_VERSION}={version}"
        schema = self.schema().add(CHANGE_TYPE, "string")
        changes = self.spark.read.schema(schema).parquet(folder)
        # At most four rows a partition.
        found = changes.groupBy(CHANGE_TYPE, self._part(columns).alias(PART)).count().collect()
        made = {kind: sum(r["count"] for r in found if r[CHANGE_TYPE] == kind) for kind in {r[CHANGE_TYPE] for r in found}}
        row_schema = self.schema().add(GRAVE, "boolean").add(PART, "integer")
        added = self.spark.read.schema(row_schema).parquet(self._next(version, "added"))
        parts = sorted({*(r[PART] for r in found), *(r[0] for r in added.select(PART).distinct().collect())})
        if parts:
            seen = self.spark.read.schema(self.schema().add(PART, "integer").add(ACT, "string")).parquet(self._next(version, "rows"))
            left = seen.where(stays()).select(*columns, F.lit(False).alias(GRAVE), PART)
            after = left.where(F.col(PART).isin(parts)).unionByName(added)
            self._replace(after, parts)
        if not made:
            paths.delete(self.spark, folder)
        if made or source_version is not None:
            self._mark(version, source_version, made)
        paths.delete(self.spark, f"{self.path}/next")

    def _replace(self, after: DataFrame, parts: list[int]) -> None:
        """Replace the partitions; those that have no rows any more go."""
        self._write(after, "dynamic")
        filled = {r[0] for r in after.select(PART).distinct().collect()}
        for part in set(parts) - filled:
            paths.delete(self.spark, f"{self.path}/rows/{PART}={part}")

    def _mark(self, version: int, source_version: int | None, made: dict[str, int]) -> None:
        root = f"{self.path}/commits"
        row = self.spark.range(0, 1, 1, 1).select(
            F.current_timestamp().alias("committed_at"),
            F.lit(source_version).cast("bigint").alias("source_version"),
            *[F.lit(made.get(kind, 0)).cast("bigint").alias(name) for name, kind in COUNTS.items()],
        )
        row.write.mode("overwrite").parquet(f"{root}/{COMMIT_VERSION}={version}")
        for old in sorted(map(int, paths.partition_values(self.spark, root, COMMIT_VERSION)))[:-MARKERS]:
            paths.delete(self.spark, f"{root}/{COMMIT_VERSION}={old}")
