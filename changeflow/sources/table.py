"""A keyed table as plain parquet directories, one per commit, with its row changes.

    <path>/state/version=N/               all rows as of commit N
    <path>/changes/_commit_version=N/     row changes of commit N
    <path>/commits/_commit_version=N/     one row; its arrival makes commit N visible
    <path>/progress/                      checkpoint of the stream that feeds the table

A directory is written once and never touched again: a commit that died half way is simply done again, and a
commit that is done is left alone, so the number of a commit alone makes repeats harmless. There is one writer
per table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, any_null, as_list
from changeflow.operators.merge import REFERENCE, apply_changes, row_changes
from changeflow.sources import paths

# What a commit row says besides its time.
COMMIT_FIELDS = {
    "source_version": "bigint",
    "schema": "string",
    "n_rows": "bigint",
    "n_insert": "bigint",
    "n_update": "bigint",
    "n_delete": "bigint",
}
COMMIT_SCHEMA = ", ".join(["committed_at timestamp", *[f"{n} {t}" for n, t in COMMIT_FIELDS.items()]])


def _typed(df: DataFrame, schema: StructType, *extra: str) -> DataFrame:
    """Columns in table order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], *extra)


class KeyedTable:
    """``keep`` states, the newest ones, stay on disk; all of them by default. Row changes always stay."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str], keep: int | None = None):
        self.spark, self.path, self.key, self.keep = spark, path.rstrip("/"), as_list(key), keep
        self._commits: dict[int, Row] = {}

    # -- reading ----------------------------------------------------------------------------

    def version(self) -> int | None:
        """Newest commit, or None when the table does not exist yet."""
        root = f"{self.path}/commits"
        for version in sorted(map(int, paths.partition_values(self.spark, root, COMMIT_VERSION)), reverse=True):
            names = paths.child_names(self.spark, f"{root}/{COMMIT_VERSION}={version}")
            if any(name.startswith("part-") for name in names):
                return version
        return None

    def exists(self) -> bool:
        return self.version() is not None

    def commit_row(self, version: int | None = None) -> Row:
        if version is None:
            version = self.version()
            if version is None:
                raise FileNotFoundError(f"no keyed table at {self.path}")
        if version not in self._commits:
            path = f"{self.path}/commits/{COMMIT_VERSION}={version}"
            self._commits[version] = self.spark.read.schema(COMMIT_SCHEMA).parquet(path).first()
        return self._commits[version]

    def schema(self, version: int | None = None) -> StructType:
        return StructType.fromJson(json.loads(self.commit_row(version).schema))

    def _state(self, version: int) -> str:
        return f"{self.path}/state/version={version}"

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version."""
        version = self.version() if version is None else version
        return self.spark.read.schema(self.schema(version)).parquet(self._state(version))

    def register(self, name: str, version: int | None = None) -> None:
        """Make the table available to SQL under a name."""
        self.read(version).createOrReplaceTempView(name)

    def read_keys(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of the table at a version that have one of the given keys."""
        return self.read(version).join(keys.select(*self.key), self.key, "left_semi")

    def read_changes(self, first: int, last: int | None = None) -> DataFrame:
        """Row changes of committed versions ``first`` to ``last`` (default: the newest); only their directories are
        read. ``first`` may be the next version to come, which has no rows yet; other missing versions are refused."""
        newest = self.version()
        last = newest if last is None else last
        if last > newest or first > newest + 1:
            raise ValueError(f"{self.path}: versions {first} to {last} asked for, {newest} is the newest")
        schema = (
            self.schema()
            .add(CHANGE_TYPE, "string")
            .add(COMMIT_VERSION, "long")
            .add(COMMIT_TIMESTAMP, "timestamp")
        )
        first = max(first, 1)  # the bootstrap has no row changes
        if first > last:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path}/changes"
        reader = self.spark.read.schema(schema).option("basePath", root)
        directories = [f"{root}/{COMMIT_VERSION}={v}" for v in range(first, last + 1)]
        return reader.parquet(*directories).select(*schema.names)

    def stream_commits(self, commits_per_trigger: int | None = None) -> DataFrame:
        """Commits as a stream. A commit appears in one piece, after its row changes are complete."""
        reader = self.spark.readStream.schema(f"committed_at timestamp, {COMMIT_VERSION} bigint")
        reader = reader.option("maxFileAge", "36500d")
        if commits_per_trigger:
            reader = reader.option("maxFilesPerTrigger", commits_per_trigger)
        return reader.parquet(f"{self.path}/commits")

    # -- writing ----------------------------------------------------------------------------

    def overwrite(self, df: DataFrame, source_version: int | None = None) -> None:
        """Store ``df`` as the whole of a new table, as commit 0."""
        if self.exists():
            raise ValueError(f"{self.path} holds a table already")
        self._write_state(df, 0)
        n_rows = self.spark.read.schema(df.schema).parquet(self._state(0)).count()
        self._commit(0, schema=df.schema.json(), n_rows=n_rows, source_version=source_version)

    def merge(
        self,
        version: int,
        source: DataFrame,
        op: str = "_operation",
        mode: str = REFERENCE,
        guard: str | None = None,
        source_version: int | None = None,
    ) -> None:
        """Merge a change set as commit ``version``; a done commit is left alone.

        ``source`` is staged first. That cuts the lineage to the stream, fixes the rows for the commit, and gives the
        planner its size. It must hold one row per key: a repeated key is refused, for it would multiply rows.
        """
        if self.is_done(version):
            return
        schema = self.schema(version - 1)
        staged_path = f"{self.path}/staged/{COMMIT_VERSION}={version}"
        source = _typed(source, schema, *([op] if op not in schema.names else []))
        source.write.mode("overwrite").parquet(staged_path)
        staged = self.spark.read.schema(source.schema).parquet(staged_path)
        repeated = staged.where(~any_null(self.key)).groupBy(*self.key).count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"{self.path}: the change set has {repeated['count']} rows for one key: {repeated}")
        self.commit(version, row_changes(self.read(version - 1), staged, self.key, op, mode, guard), source_version)
        paths.delete(self.spark, staged_path)

    def commit(self, version: int, changes: DataFrame, source_version: int | None = None) -> None:
        """Store row changes (table columns and ``_change_type``) and the state they lead to as commit ``version``."""
        if self.is_done(version):
            return
        before = self.commit_row(version - 1)
        schema = self.schema(version - 1)
        path = f"{self.path}/changes/{COMMIT_VERSION}={version}"
        stored = _typed(changes, schema, CHANGE_TYPE).withColumn(COMMIT_TIMESTAMP, F.current_timestamp())
        # Few files, whatever the number of tasks that found changes.
        stored.hint("rebalance").write.mode("overwrite").parquet(path)
        changes = self.spark.read.schema(stored.schema).parquet(path)
        made = {r[CHANGE_TYPE]: r["count"] for r in changes.groupBy(CHANGE_TYPE).count().collect()}
        self._write_state(apply_changes(self.read(version - 1), changes, self.key, one_commit=True), version)
        self._commit(
            version,
            schema=before.schema,
            n_rows=before.n_rows + made.get("insert", 0) - made.get("delete", 0),
            source_version=source_version,
            n_insert=made.get("insert", 0),
            n_update=made.get("update_postimage", 0),
            n_delete=made.get("delete", 0),
        )
        if self.keep is not None:
            paths.delete(self.spark, self._state(version - self.keep))

    def is_done(self, version: int) -> bool:
        """Whether commit ``version`` is there; it must be that or the next one."""
        current = self.version()
        if current < version - 1:
            raise ValueError(f"{self.path}: commit {version} cannot follow {current}")
        return current >= version

    def _write_state(self, df: DataFrame, version: int) -> None:
        """Write all rows; what a commit that died has left in the directory goes."""
        df.write.mode("overwrite").parquet(self._state(version))

    def _commit(self, version: int, **values) -> None:
        """Write the commit row. One row, one file: the commit becomes visible at once."""
        row = self.spark.range(0, 1, 1, 1).select(
            F.current_timestamp().alias("committed_at"),
            *[F.lit(values.get(name)).cast(kind).alias(name) for name, kind in COMMIT_FIELDS.items()],
        )
        row.write.mode("overwrite").parquet(f"{self.path}/commits/{COMMIT_VERSION}={version}")
