"""Runs that bring tables up to date from change files and from each other's row changes.

Every run is a stream with ``availableNow``: it takes what is there, commits and ends. Batch ``i`` of a stream of change
files is commit ``i + 1`` of its table (commit 0 is the bootstrap), so a batch that is repeated after a failure finds its
commit done and does nothing. A table fed by another one notes the last of the other's versions it holds; a batch
whose versions it holds is passed over. The tables are ``PartitionedTable`` or ``KeyedTable``.

Inside a batch only the reduction to one row per key runs on the stream's plan, which knows nothing of
sizes; the table stages the result, and the merge is planned from there in the caller's session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import CHANGE_TYPE, COMMIT_VERSION
from changeflow.functions.schemas import COLUMN, REASON, REJECT, ROW, load_schema, split
from changeflow.operators.derive import changes_by_query, derived_changes, latest_operations
from changeflow.operators.distinct import classify_counts, count_row_changes, set_changes, value_counts, value_deltas
from changeflow.operators.guarded import guarded_changes
from changeflow.operators.latest import latest
from changeflow.operators.merge import LATEST_WINS, NEW_IMAGES, REFERENCE
from changeflow.operators.replay import ACTION, net_changes
from changeflow.sources import files, paths
from changeflow.sources.partitioned import PartitionedTable
from changeflow.sources.table import KeyedTable


def run_to_end(stream: DataFrame, progress: str, step: Callable[[DataFrame, int], None]) -> None:
    """Run ``step`` on all that is available, batch by batch; a failure is raised here."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def follow(
    source: PartitionedTable | KeyedTable,
    progress: str,
    step: Callable[[DataFrame, int, range], None],
    seen: Callable[[], int],
    commits_per_trigger: int | None = None,
) -> None:
    """Stream the row changes of a table: ``step(changes, batch_id, versions)`` for new commits.

    The stream only says that there are new commits, which may reach it in any order (file times are coarse, and copies
    have new ones). What is handed out are the versions after ``seen()``, the last one that the consumer has stored, up
    to the newest, or as many as ``commits_per_trigger``. A batch whose versions went with an earlier one is passed
    over.
    """

    def batch(commits: DataFrame, batch_id: int) -> None:
        first, last = seen() + 1, source.version()
        if commits_per_trigger:
            last = min(last, first + commits_per_trigger - 1)
        if first <= last:
            step(source.read_changes(first, last), batch_id, range(first, last + 1))

    run_to_end(source.stream_commits(commits_per_trigger), progress, batch)


def _progress(table: PartitionedTable | KeyedTable) -> str:
    """Checkpoint of the stream that feeds a table; without it the batch numbers would start anew."""
    progress = f"{table.path}/progress"
    if not table.exists():
        raise FileNotFoundError(f"no keyed table at {table.path}; bootstrap it first")
    if table.version() > 0 and not paths.exists(table.spark, f"{progress}/offsets"):
        raise RuntimeError(f"{table.path} has commits but its stream progress is gone; bootstrap a new directory")
    return progress


def _bootstrap(table: PartitionedTable | KeyedTable, load: Callable[[], DataFrame], **options) -> bool:
    """Load the table if it is absent; stale stream progress next to it is dropped first."""
    if table.exists():
        return False
    paths.delete(table.spark, f"{table.path}/progress")
    table.overwrite(load(), **options)
    return True


class BronzeIngest:
    """A keyed table from one full load and a directory of change files.

    ``order`` are the columns that decide which change of a key is the latest. With ``batch``, the
    files of one stream batch may hold several landed batches, told apart by that column, and are
    applied as if one by one. With ``guard``, a change older than its stored row is ignored; ``keep_deleted``, a condition
    on the guard's column, says which deleted keys are remembered, so that older changes don't bring them back. With ``on_loss``, files may disagree with ``schema``
    and each other on the types of columns: they are read as they are and cast, and a value that has no equal raises an
    error ("raise"), becomes NULL ("null"), or its row is left out and kept with the reason under the table's directory
    ("reject"; so are malformed rows of text files). ``schema`` is a struct or the path of a schema document; ``file_format`` is that
    of the full load and the change files.
    """

    def __init__(
        self,
        table: PartitionedTable | KeyedTable,
        schema: StructType | str,
        order: str | Sequence[str],
        op: str = "_operation",
        mode: str = REFERENCE,
        batch: str | None = None,
        guard: str | None = None,
        file_format: str = "parquet",
        keep_deleted: str | None = None,
        on_loss: str | None = None,
    ):
        if keep_deleted is not None and (guard is None or not isinstance(table, PartitionedTable)):
            raise ValueError("deleted keys are remembered by their guard, in a PartitionedTable")
        schema = load_schema(table.spark, schema) if isinstance(schema, str) else schema
        self.table, self.schema, self.order, self.file_format = table, schema, order, file_format
        self.op, self.mode, self.batch, self.guard, self.keep_deleted = op, mode, batch, guard, keep_deleted
        self.on_loss = on_loss

    def bootstrap(self, snapshot: str | DataFrame) -> bool:
        def load() -> DataFrame:
            if isinstance(snapshot, DataFrame):
                return snapshot
            if self.on_loss is None or self.file_format != "parquet":
                return files.read_snapshot(self.table.spark, snapshot, self.schema, self.file_format)
            if self.on_loss == REJECT:
                good, bad = files.split_drifting(self.table.spark, [snapshot], self.schema)
                self._keep_rejected(bad, 0)
                return good
            return files.read_drifting(self.table.spark, [snapshot], self.schema, self.on_loss)

        return _bootstrap(self.table, load)

    def execute(self, snapshots: str, changes_path: str) -> None:
        """Bootstrap from the newest complete full load if the table is absent, then run."""
        if not self.table.exists():
            self.bootstrap(files.newest_snapshot(self.table.spark, snapshots))
        self.run(changes_path)

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        key, options = self.table.key, {}
        if isinstance(self.table, PartitionedTable):
            options["unique"] = self.batch is None or self.guard is None  # folded, as below
        if self.keep_deleted is not None:
            options["keep_deleted"] = self.keep_deleted
        if self.batch is None:
            source, op = latest(changes, key, self.order, self.op), self.op
        elif self.guard is None:
            source, op = net_changes(changes, key, self.batch, self.order, self.op, self.mode), ACTION
        else:
            source, op = self._guarded(changes), ACTION
            options["guarded"] = True
        self.table.merge(batch_id + 1, source, op, self.mode, self.guard, **options)

    def _guarded(self, changes: DataFrame) -> DataFrame:
        if not isinstance(self.table, PartitionedTable):
            raise ValueError("batches with a guard are folded into a PartitionedTable only")
        remembers = self.keep_deleted is not None
        return guarded_changes(
            self.table.read(), changes, self.table.key, self.batch, self.order, self.guard, self.op, self.mode, remembers,
            self.table.read_deleted() if remembers else None,
        )

    def run(self, changes_path: str, files_per_trigger: int | None = None, **options: str) -> None:
        """Apply the change files that are there. By default they form one batch; ``files_per_trigger``
        cuts smaller ones, which must not split a landed batch of several files."""
        progress = _progress(self.table)
        spark, drifting = self.table.spark, self.on_loss is not None and self.file_format == "parquet"
        if drifting:
            # Streams of names and of rows keep their progress in different forms.
            stream = files.stream_names(spark, changes_path, files_per_trigger)
            options = {"basePath": changes_path, **options}
        else:
            rejects = self.on_loss == REJECT
            stream = files.stream_changes(
                spark, changes_path, self.schema, files_per_trigger, self.file_format, rejects, **options
            )

        def step(batch: DataFrame, batch_id: int) -> None:
            changes = self._read(batch, batch_id, options) if drifting else batch
            if self.on_loss == REJECT and not drifting:
                changes, bad = split(batch, self.schema)
                self._keep_rejected(bad, batch_id + 1)
            if changes is not None:
                self.upsert(changes, batch_id)

        run_to_end(stream, progress, step)

    def _read(self, names: DataFrame, batch_id: int, options: dict[str, str]) -> DataFrame | None:
        """The rows of a batch of files; their names are as many as the stream's own list of the batch."""
        found = [r.path for r in names.collect()]
        if not found:
            return None
        if self.on_loss != REJECT:
            return files.read_drifting(self.table.spark, found, self.schema, self.on_loss, **options)
        good, bad = files.split_drifting(self.table.spark, found, self.schema, **options)
        self._keep_rejected(bad, batch_id + 1)
        return good

    def _keep_rejected(self, bad: DataFrame, version: int) -> None:
        """Written before the batch is committed, over what an earlier attempt has left."""
        folder = f"{self.table.path}/rejected/{COMMIT_VERSION}={version}"
        if not bad.isEmpty():
            bad.hint("rebalance").write.mode("overwrite").parquet(folder)

    def read_rejected(self) -> DataFrame:
        """Rejected rows: column, reason, the source row as JSON, and the batch that held them."""
        spark, root = self.table.spark, f"{self.table.path}/rejected"
        schema = f"{COLUMN} string, {REASON} string, {ROW} string, {COMMIT_VERSION} bigint"
        return spark.read.schema(schema).parquet(root) if paths.exists(spark, root) else spark.createDataFrame([], schema)


class _Downstream:
    """A table fed by the row changes of another one.

    The bootstrap notes which version of the source it read; commits up to it are skipped later.
    """

    def __init__(self, table: PartitionedTable | KeyedTable, source: PartitionedTable | KeyedTable):
        self.table, self.source = table, source

    def _initial(self, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _apply(self, version: int, changes: DataFrame, source_versions: range) -> None:
        raise NotImplementedError

    def bootstrap(self) -> bool:
        version = self.source.version()
        return _bootstrap(
            self.table,
            lambda: self._initial(self.source.read(version)),
            source_version=version,
        )

    def upsert(self, changes: DataFrame, batch_id: int, source_versions: range) -> None:
        self._apply(self.table.version() + 1, changes, source_versions)

    def run(self, commits_per_trigger: int | None = None) -> None:
        self.bootstrap()
        follow(self.source, _progress(self.table), self.upsert, self._seen, commits_per_trigger)

    def _seen(self) -> int:
        """The last source version that the table holds."""
        return self.table.commit_row().source_version


class SilverIngest(_Downstream):
    """A projection of a keyed table, kept current.

    ``columns`` are names or expressions over the source row, ``where`` an optional filter; a row that
    stops passing it leaves. The source's key is kept, if under another name. In place of both, SQL text over ``{source}``
    may be given.

    By default the row changes of the source are turned into those of the projection, without reading
    either table. ``reference`` mode instead merges the latest row change per key: an insert then
    leaves an existing row alone, which differs when several source commits fall into one batch.
    """

    def __init__(
        self,
        table: PartitionedTable | KeyedTable,
        source: PartitionedTable | KeyedTable,
        columns: Sequence[str | Column] | str,
        where: Column | None = None,
        mode: str = LATEST_WINS,
    ):
        super().__init__(table, source)
        self.query = columns if isinstance(columns, str) else None
        self.columns, self.where, self.mode = list(columns), where, mode
        if self.query is not None and (where is not None or mode == REFERENCE):
            raise ValueError("SQL text holds its own filter, and goes with the default mode")

    def _initial(self, rows: DataFrame) -> DataFrame:
        if self.query is not None:
            return rows.sparkSession.sql(self.query, source=rows)
        return (rows if self.where is None else rows.where(self.where)).select(*self.columns)

    def _apply(self, version: int, changes: DataFrame, source_versions: range) -> None:
        upto, one = source_versions.stop - 1, len(source_versions) == 1
        if self.query is not None:
            self.table.commit(version, changes_by_query(changes, self.source.key, self.query, self.table.key, one), upto)
        elif self.mode == REFERENCE:
            latest_ = latest_operations(changes, self.source.key, self.columns, self.where)
            self.table.merge(version, latest_, source_version=upto)
        else:
            changes = derived_changes(changes, self.source.key, self.columns, self.where, one)
            self.table.commit(version, changes, upto)


class DistinctIngest(_Downstream):
    """The distinct non-null values of one column of a keyed table, or of several together, kept current.

    ``query``, SQL text over ``{source}`` that takes each row by itself, may give the values.
    The table holds each value with its number of source rows; ``read`` and ``read_changes`` show
    the set.
    """

    def __init__(
        self, table: PartitionedTable | KeyedTable, source: PartitionedTable | KeyedTable, query: str | None = None
    ):
        super().__init__(table, source)
        self.column, self.query = table.key, query

    def _initial(self, rows: DataFrame) -> DataFrame:
        rows = rows if self.query is None else rows.sparkSession.sql(self.query, source=rows)
        return value_counts(rows, self.column)

    def _apply(self, version: int, changes: DataFrame, source_versions: range) -> None:
        if self.query is not None:
            images = changes.sparkSession.sql
            sides = [
                images(self.query, source=changes.where(is_new if new else ~is_new)).withColumn(CHANGE_TYPE, F.lit(kind))
                for is_new in [F.col(CHANGE_TYPE).isin(*NEW_IMAGES)]
                for new, kind in ((True, "insert"), (False, "delete"))
            ]
            changes = sides[0].unionByName(sides[1])
        deltas = paths.stage(value_deltas(changes, self.column))
        if isinstance(self.table, PartitionedTable) and self.table.is_large(deltas):
            self.table.commit_all(version, lambda counts: classify_counts(counts, deltas, self.column), source_versions.stop - 1)
        else:
            changes = count_row_changes(self.table.read_keys(deltas), deltas, self.column)
            self.table.commit(version, changes, source_versions.stop - 1)
        paths.unstage(deltas)

    def read(self, version: int | None = None) -> DataFrame:
        return self.table.read(version).select(*self.column)

    def read_changes(self, first: int, last: int | None = None) -> DataFrame:
        return set_changes(self.table.read_changes(first, last))
