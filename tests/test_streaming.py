"""Stream runs: restarts, lost progress, derived tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import REPLACE
from changeflow.operators.merge import REFERENCE
from changeflow.plans import loyalty
from changeflow.sources import files, paths
from changeflow.sources.partitioned import PartitionedTable
from changeflow.sources.table import KeyedTable
from changeflow.streaming.ingest import BronzeIngest, DistinctIngest, SilverIngest, follow
from tests.test_merge import bag

SCHEMA = "k int, p string, v int, o int, _operation string"


class Pair:
    """A bronze table with a filtered projection and a distinct set behind it."""

    def __init__(self, spark, root, rows, kind=KeyedTable):
        self.spark, self.root = spark, root
        self.bronze = BronzeIngest(kind(spark, f"{root}/bronze", "k"), StructType.fromDDL(SCHEMA), "o")
        self.bronze.bootstrap(spark.createDataFrame(rows, SCHEMA))
        table = self.bronze.table
        self.silver = SilverIngest(
            kind(spark, f"{root}/silver", "id"), table, [F.col("k").alias("id"), "v"], where=F.col("v") >= 0
        )
        self.products = DistinctIngest(kind(spark, f"{root}/products", "p"), table)

    def land(self, *rows):
        self.spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/cdc")

    def run_bronze(self):
        self.bronze.run(f"{self.root}/cdc")

    def run_derived(self):
        self.silver.run()
        self.products.run()

    def check(self):
        rows = self.bronze.table.read().collect()
        assert bag(self.silver.table.read().collect()) == bag([(r.k, r.v) for r in rows if r.v is not None and r.v >= 0])
        got = [r.p for r in self.products.read().collect()]
        assert len(got) == len(set(got)) and set(got) == {r.p for r in rows if r.p is not None}


ROWS = [(k, f"p{k % 4}", k, 0, None) for k in range(12)]


def partitioned(spark, path, key):
    return PartitionedTable(spark, path, key, partitions=4)


KINDS = pytest.mark.parametrize("kind", [KeyedTable, partitioned])


@KINDS
def test_derived_tables_follow(spark, root, kind):
    t = Pair(spark, root, ROWS, kind)
    t.land((0, "p0", 5, 1, "UPDATE"), (1, "q", 5, 1, "UPDATE"), (20, "r", 1, 1, "INSERT"), (21, None, 1, 1, "INSERT"))
    t.run_bronze()
    t.run_derived()
    t.check()
    # p2 is held by 2, 6 and 10: it stays until the last of them goes. 5 leaves by the filter.
    t.land((2, "p2", 2, 2, "DELETE"), (6, "p2", 2, 2, "DELETE"), (5, "p1", -1, 2, "UPDATE"))
    t.run_bronze()
    t.run_derived()
    t.check()
    assert "p2" in {r.p for r in t.products.read().collect()}
    # Moved to another product, moved back into the filter; several commits fall into one batch.
    t.land((10, "s", 1, 3, "UPDATE"), (5, "p1", 7, 3, "UPDATE"), (None, "n", 1, 3, "INSERT"))
    t.run_bronze()
    t.land((20, "r", 1, 4, "DELETE"), (None, "n", 2, 4, "INSERT"))
    t.run_bronze()
    t.land((20, "r2", 9, 5, "INSERT"))
    t.run_bronze()
    t.run_derived()
    t.check()
    moved = bag(t.products.read_changes(2).select("p", "_change_type").collect())
    assert moved == bag([("p2", "delete"), ("s", "insert"), ("n", "insert"), ("r", "delete"), ("r2", "insert")])


@KINDS
def test_idle_run_and_restart(spark, root, kind):
    t = Pair(spark, root, ROWS, kind)
    t.land((0, "x", 5, 1, "UPDATE"))
    t.run_bronze()
    t.run_derived()
    versions = [x.version() for x in (t.bronze.table, t.silver.table, t.products.table)]
    again = Pair.__new__(Pair)
    again.__dict__.update(t.__dict__)
    again.run_bronze()
    again.run_derived()
    assert [x.version() for x in (t.bronze.table, t.silver.table, t.products.table)] == versions
    assert t.bronze.bootstrap(spark.createDataFrame(ROWS, SCHEMA)) is False


@pytest.mark.parametrize("where", ["bronze", "silver", "products"])
@pytest.mark.parametrize("step", ["before", "mark", "after"])
def test_crash_of_partitioned_tables(spark, root, where, step, monkeypatch):
    """Dying before the partitions are replaced, before the commit is marked, or just after it."""
    t = Pair(spark, root, ROWS, partitioned)
    t.silver.bootstrap()
    t.products.bootstrap()
    t.land((0, "x", 5, 1, "UPDATE"), (3, None, 0, 1, "DELETE"), (30, "y", 1, 1, "INSERT"))
    doomed = {"bronze": t.bronze, "silver": t.silver, "products": t.products}[where].table
    name = "_replace" if step == "before" else "_mark"
    done = getattr(PartitionedTable, name)

    def dying(self, *args):
        if self.path != doomed.path:
            return done(self, *args)
        if step == "after":
            done(self, *args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, name, dying)
        with pytest.raises(Exception, match="lost"):
            t.run_bronze()
            t.run_derived()
    t.run_bronze()
    t.run_derived()
    t.check()
    assert t.bronze.table.version() == 1 and t.bronze.table.read_changes(1).count() == 4
    assert bag(t.products.read_changes(1).select("p", "_change_type").collect()) == bag([("x", "insert"), ("y", "insert")])


def test_versions_without_effect_are_passed(spark, root):
    """Source versions that change nothing in the projection write no rows, and are not read again."""
    t = Pair(spark, root, ROWS, partitioned)
    t.silver.bootstrap()
    for n in range(1, 4):
        t.land((90 + n, "x", -5, 1, "INSERT"))  # fails the projection's filter
        t.run_bronze()
    before = t.silver.table.read().inputFiles()
    t.silver.run(commits_per_trigger=1)
    assert sorted(t.silver.table.read().inputFiles()) == sorted(before)
    assert t.silver.table.commit_row().source_version == 3
    t.silver.run()
    assert t.silver.table.version() == 3
    assert t.silver.table.read().count() == 12


@pytest.mark.parametrize("where", ["bronze", "silver", "products"])
@pytest.mark.parametrize("step", ["before", "after"])
def test_crash_and_restart(spark, root, where, step, monkeypatch):
    """Dying just before or just after the commit: the batch is repeated without doubling anything."""
    t = Pair(spark, root, ROWS)
    t.run_derived_tables = t.run_derived
    t.silver.bootstrap()
    t.products.bootstrap()
    t.land((0, "x", 5, 1, "UPDATE"), (3, None, 0, 1, "DELETE"), (30, "y", 1, 1, "INSERT"))
    doomed = {"bronze": t.bronze, "silver": t.silver, "products": t.products}[where].table
    commit = KeyedTable._commit

    def dying(self, version, **values):
        if self.path != doomed.path:
            return commit(self, version, **values)
        if step == "after":
            commit(self, version, **values)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", dying)
        with pytest.raises(Exception, match="lost"):
            t.run_bronze()
            t.run_derived()
    t.run_bronze()
    t.run_derived()
    t.check()
    assert t.bronze.table.version() == 1
    assert t.bronze.table.read_changes(1).count() == 4
    assert bag(t.products.read_changes(1).select("p", "_change_type").collect()) == bag([("x", "insert"), ("y", "insert")])


def test_bootstrap_later_than_the_first_commits(spark, root):
    """Commits already contained in the derived table's bootstrap are not applied again."""
    t = Pair(spark, root, ROWS)
    t.land((0, "x", 5, 1, "UPDATE"), (30, "y", 1, 1, "INSERT"))
    t.run_bronze()
    t.land((30, "y", 1, 2, "DELETE"))
    t.run_bronze()
    t.run_derived()
    t.check()
    assert t.silver.table.commit_row(0).source_version == 2
    assert t.silver.table.read_changes(1).count() == 0


def test_lost_progress_is_refused(spark, root):
    t = Pair(spark, root, ROWS)
    t.land((0, "x", 5, 1, "UPDATE"))
    t.run_bronze()
    paths.delete(spark, f"{t.bronze.table.path}/progress")
    t.land((0, "z", 6, 2, "UPDATE"))
    with pytest.raises(RuntimeError, match="progress"):
        t.run_bronze()


def test_backlog_in_one_run_equals_runs_in_turn(spark, root):
    schema = StructType.fromDDL(SCHEMA + ", b int")
    feed = [
        (k % 15, f"p{k % 3}", k, k % 5, ["INSERT", "UPDATE", "DELETE"][(k * k + k // 3) % 3], 1 + k % 4) for k in range(80)
    ]
    results = []
    for batch in (None, "b"):
        table = KeyedTable(spark, f"{root}/t{batch}", "k")
        ingest = BronzeIngest(table, schema, "o", batch=batch)
        ingest.bootstrap(spark.createDataFrame([(k, "p", k, 0, None, 0) for k in range(8)], schema))
        df = spark.createDataFrame(feed, schema)
        if batch:
            df.write.parquet(f"{root}/all")
            ingest.run(f"{root}/all")
            assert table.version() == 1
        else:
            for number in range(1, 5):
                df.where(f"b = {number}").write.mode("append").parquet(f"{root}/turn")
                ingest.run(f"{root}/turn")
            assert table.version() == 4
        results.append(bag(table.read().collect()))
        assert REPLACE not in str(results[-1])
    assert results[0] == results[1]


def test_late_change_and_guard(spark, root):
    for guard, want in ((None, "y"), ("o", "x")):
        table = KeyedTable(spark, f"{root}/{guard}", "k")
        ingest = BronzeIngest(table, StructType.fromDDL(SCHEMA), "o", guard=guard)
        ingest.bootstrap(spark.createDataFrame([(1, "a", 0, 0, None)], SCHEMA))
        for p, o in (("x", 9), ("y", 5)):
            spark.createDataFrame([(1, p, 0, o, "UPDATE")], SCHEMA).write.mode("append").parquet(f"{root}/cdc{guard}")
            ingest.run(f"{root}/cdc{guard}")
        assert [r.p for r in table.read().collect()] == [want]


def test_run_needs_a_table(spark, root):
    ingest = BronzeIngest(KeyedTable(spark, f"{root}/none", "k"), StructType.fromDDL(SCHEMA), "o")
    with pytest.raises(FileNotFoundError, match="bootstrap"):
        ingest.run(f"{root}/cdc")


def test_one_file_per_batch(spark, root):
    t = Pair(spark, root, ROWS)
    t.land((1, "x", 5, 1, "DELETE"))
    t.land((1, "z", 5, 2, "INSERT"))
    t.bronze.run(f"{root}/cdc", files_per_trigger=1)
    assert t.bronze.table.version() == 2
    assert [r.p for r in t.bronze.table.read().where("k = 1").collect()] == ["z"]


def test_loyalty_run(spark, root):
    """All seven tables from raw directories, twice."""
    raw = f"{root}/raw"
    metadata = {"clientes": ("c1", 1, 0, 0, 0, 0, 10, "2024-01-01", "2024-01-01"),
                "transacoes": ("t1", "c1", "2024-01-01", 5, "app"),
                "transacao_produto": ("i1", "t1", "p1", 1, 5)}
    for name, spec in loyalty.BRONZE.items():
        columns = StructType.fromDDL(spec.columns)
        files.land_snapshot(spark.createDataFrame([metadata[name]], columns), f"{raw}/full_load/{name}", "2024-01-01T00:00:00")
        changed = spark.createDataFrame([metadata[name], ("new", *metadata[name][1:])], columns)
        operation = F.when(F.col(spec.key) == "new", "INSERT").otherwise("DELETE")
        files.land_changes(changed.withColumn("_operation", operation), f"{raw}/cdc/{name}", "2024-01-02T00:00:00")
    for _ in range(2):
        loyalty.run(spark, raw, root)
        for name in loyalty.BRONZE:
            derived = loyalty.silver(spark, root, name).table
            assert derived.read().columns == StructType.fromDDL(loyalty.BRONZE[name].columns).names
            assert [tuple(r) for r in derived.read().collect()] == [("new", *metadata[name][1:])]
        assert [tuple(r) for r in loyalty.silver(spark, root, "produtos").read().collect()] == [("p1",)]


@KINDS
def test_reference_mode_of_the_derived_table(spark, root, kind):
    """Deleted and inserted again within one batch: in reference mode the insert meets the old row."""
    t = Pair(spark, root, ROWS, kind)
    t.silver.mode = REFERENCE
    t.silver.bootstrap()
    t.land((1, "p", 1, 1, "DELETE"))
    t.run_bronze()
    t.land((1, "p", 99, 2, "INSERT"))
    t.run_bronze()
    t.silver.run()
    assert (1, 1) in [tuple(r) for r in t.silver.table.read().collect()]


@KINDS
def test_follow_hands_out_each_change_once(spark, root, kind):
    """A consumer of its own: all row changes, commit by commit, and none twice."""
    t = Pair(spark, root, ROWS, kind)
    seen = []

    def last():
        return seen[-1][1].stop - 1 if seen else 0

    def step(changes, batch_id, versions):
        seen.append((batch_id, versions, bag(changes.select("k", "_change_type", "_commit_version").collect())))

    t.land((0, "x", 5, 1, "UPDATE"))
    t.run_bronze()
    t.land((40, "x", 5, 1, "INSERT"))
    t.run_bronze()
    follow(t.bronze.table, f"{root}/consumer", step, last)
    t.land((40, "x", 5, 2, "DELETE"))
    t.run_bronze()
    follow(t.bronze.table, f"{root}/consumer", step, last)
    follow(t.bronze.table, f"{root}/consumer", step, last)
    assert seen == [
        (0, range(1, 3), bag([(0, "update_preimage", 1), (0, "update_postimage", 1), (40, "insert", 2)])),
        (1, range(3, 4), bag([(40, "delete", 3)])),
    ]


def test_commits_are_taken_in_order_whatever_their_file_times(spark, root):
    """The newest commit's file is the oldest: the derived table still ends with the newest value."""
    import glob
    import os

    t = Pair(spark, root, ROWS)
    t.silver.bootstrap()
    for o in (1, 2, 3):
        t.land((1, "x", o * 10, o, "UPDATE"))
        t.run_bronze()
    for n, file in enumerate(sorted(glob.glob(f"{t.bronze.table.path}/commits/_commit_version=*/part-*"), reverse=True)):
        os.utime(file, (1_600_000_000 + 100 * n,) * 2)
    t.silver.run(commits_per_trigger=1)
    assert (1, 30) in [tuple(r) for r in t.silver.table.read().collect()]
    assert [t.silver.table.commit_row(n).source_version for n in range(4)] == [0, 1, 2, 3]


def test_change_file_that_lands_late_is_read(spark, root):
    import glob
    import os

    t = Pair(spark, root, ROWS)
    t.land((1, "new", 5, 1, "UPDATE"))
    t.run_bronze()
    before = set(glob.glob(f"{root}/cdc/part-*"))
    t.land((2, "late", 5, 1, "UPDATE"))
    for file in set(glob.glob(f"{root}/cdc/part-*")) - before:
        os.utime(file, (1_500_000_000,) * 2)
    t.run_bronze()
    assert {r.p for r in t.bronze.table.read().where("k IN (1, 2)").collect()} == {"new", "late"}


def test_json_files_with_a_schema_document(spark, root, tmp_path):
    (tmp_path / "t.json").write_text(StructType.fromDDL(SCHEMA).json())
    table = KeyedTable(spark, f"{root}/json", "k")
    ingest = BronzeIngest(table, str(tmp_path / "t.json"), "o", file_format="json")
    spark.createDataFrame(ROWS, SCHEMA).write.json(f"{root}/full")
    ingest.bootstrap(f"{root}/full")
    spark.createDataFrame([(1, "x", 5, 1, "UPDATE"), (2, "p", 0, 1, "DELETE")], SCHEMA).write.json(f"{root}/cdc")
    ingest.run(f"{root}/cdc")
    rows = {r.k: r.p for r in table.read().collect()}
    assert rows[1] == "x" and 2 not in rows and len(rows) == 11
