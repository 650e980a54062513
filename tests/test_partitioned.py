"""Partitioned tables: histories, repeats, crashes at every step, what a batch writes, tombstones."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.operators import merge as merge_module
from changeflow.sources import partitioned, paths
from changeflow.sources.partitioned import PartitionedTable
from changeflow.streaming.ingest import BronzeIngest
from tests.test_merge import CASES, TARGET, bag, change_set, expected
from tests.test_merge import table as plain
from tests.test_replay import FEED, model, rows

BASE = [(k, f"v{k}") for k in range(40)] + [(None, "n")]
OPS = "k int, v string, _operation string"


@pytest.fixture
def table(spark, root):
    t = PartitionedTable(spark, f"{root}/t", "k", partitions=8)
    t.overwrite(spark.createDataFrame(BASE, "k int, v string"))
    return t


def change(spark, *rows):
    return spark.createDataFrame(list(rows), OPS)


def state(table):
    return bag(PartitionedTable(table.spark, table.path, table.key).read().collect())


def files(table):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{table.path}/**/part-*", recursive=True)}


@pytest.mark.parametrize("case", CASES)
def test_outcomes(spark, root, case):
    batch, touched, changes = CASES[case]
    t = PartitionedTable(spark, f"{root}/t", "k", partitions=3)
    t.overwrite(plain(spark, TARGET))
    t.merge(1, change_set(spark, batch))
    assert bag(t.read().collect()) == expected(touched)
    assert bag(t.read_changes(1).select("k", "v", "_change_type").collect()) == bag(changes) if changes else t.version() == 0
    assert paths.child_names(spark, f"{t.path}/next") == []


def test_random_history_equals_the_model(spark, root):
    rng = np.random.default_rng(5)
    base = [(k, k) for k in range(0, 30, 2)] + [(4, 7)]
    t = PartitionedTable(spark, f"{root}/t", "k", partitions=5)
    t.overwrite(spark.createDataFrame(base, "k int, v int"))
    feed = []
    for b in range(1, 6):
        batch = [(int(k), str(rng.choice(["INSERT", "UPDATE", "DELETE"])), int(rng.integers(9)), 1, b) for k in set(rng.integers(0, 30, 9).tolist())]
        feed += batch
        t.merge(b, spark.createDataFrame(batch, FEED).select("k", "v", "_operation"))
        assert rows(t.read()) == model(base, feed, "reference")
    first = spark.createDataFrame(base, "k int, v int")
    assert bag(merge_module.apply_changes(first, t.read_changes(1), "k").collect()) == bag(t.read().collect())
    keys = spark.createDataFrame([(2,), (4,), (99,), (None,)], "k long")
    assert bag(t.read_keys(keys).collect()) == bag([r for r in t.read().collect() if r.k in (2, 4)])


def test_only_touched_partitions_are_written(spark, root):
    t = PartitionedTable(spark, f"{root}/t", "k", partitions=64)
    t.overwrite(spark.range(200_000).selectExpr("int(id) AS k", "string(id) AS v"))
    before = {f: x for f, x in files(t).items() if "/rows/" in f}
    t.merge(1, change(spark, (1, "x", "UPDATE"), (2, None, "DELETE"), (-1, "n", "INSERT"), (3, "kept", "INSERT")))
    after = {f: x for f, x in files(t).items() if "/rows/" in f}
    assert len(set(before) - set(after)) <= 3 and len(set(before) & set(after)) >= 61
    written = sum(after[f][1] for f in set(after) - set(before))
    assert written < sum(x[1] for x in before.values()) / 10
    assert t.read().count() == 200_000


def test_empty_batches_write_nothing(spark, table):
    before = files(table)
    table.merge(1, change(spark, (1, "x", "INSERT"), (99, None, "DELETE"), (2, "x", None), (None, "x", "DELETE")))
    table.merge(2, change(spark, (1, "x", "FOO")).where("k < 0"))
    table.commit(3, table.read().withColumn("_change_type", F.lit("insert")).where("k < 0"))
    assert files(table) == before and table.version() == 0
    table.merge(4, change(spark, (1, "x", "UPDATE")))
    assert table.version() == 4 and table.read_changes(1).count() == 2


def test_repeats_and_refusals(spark, table):
    table.merge(1, change(spark, (1, "x", "UPDATE"), (None, "m", "INSERT")))
    table.merge(1, change(spark, (1, "other", "UPDATE")))
    assert state(table) == bag([(1, "x") if k == 1 else (k, v) for k, v in BASE] + [(None, "m")])
    with pytest.raises(ValueError, match="2 rows for one key"):
        table.merge(2, change(spark, (1, "x", "UPDATE"), (1, "y", "UPDATE")))
    with pytest.raises(ValueError, match="holds a table"):
        table.overwrite(table.read())
    with pytest.raises(ValueError, match="version"):
        table.read(0)
    with pytest.raises(FileNotFoundError):
        PartitionedTable(spark, f"{table.path}/none", "k").read()


@pytest.mark.parametrize("lost", ["store", "write", "half", "mark", "clean"])
@pytest.mark.parametrize("kind", ["merge", "commit"])
def test_crash_at_every_step(spark, table, monkeypatch, lost, kind):
    """Dying at any step, between the replacement of two partitions too: the repeated batch gives the right table."""
    done = [(k, f"x{k}", "UPDATE") for k in range(10)] + [(30, None, "DELETE"), (50, "y", "INSERT"), (None, "z", "INSERT")]
    changes = [(k, f"v{k}", "update_preimage") for k in range(10)] + [(k, f"x{k}", "update_postimage") for k in range(10)]
    changes += [(30, "v30", "delete"), (50, "y", "insert"), (None, "z", "insert")]

    def run():
        if kind == "merge":
            table.merge(1, change(spark, *done))
        else:
            table.commit(1, spark.createDataFrame(changes, "k int, v string, _change_type string"))

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    def half(self, rows, mode):
        for part in paths.partition_values(spark, f"{self.path}/rows", "_part")[:3]:
            paths.delete(spark, f"{self.path}/rows/_part={part}") if int(part) in self._touched(rows, ["k", "v"]) else None
        die()

    with monkeypatch.context() as m:
        if lost == "half":
            m.setattr(PartitionedTable, "_write", half)
        elif lost == "clean":
            m.setattr(partitioned.paths, "delete", die)
        else:
            m.setattr(PartitionedTable, {"store": "_store", "write": "_write", "mark": "_mark"}[lost], die)
        with pytest.raises(RuntimeError):
            run()
    run()
    want = [(k, f"x{k}" if k is not None and k < 10 else v) for k, v in BASE if k != 30] + [(50, "y"), (None, "z")]
    assert state(table) == bag(want) and table.version() == 1
    assert bag(table.read_changes(1).select("k", "v", "_change_type").collect()) == bag(changes)


def test_emptied_partitions_and_table(spark, table):
    table.merge(1, change(spark, *[(k, None, "DELETE") for k in range(40)]))
    assert state(table) == bag([(None, "n")])
    assert len(paths.partition_values(spark, f"{table.path}/rows", "_part")) == 1
    table.merge(2, change(spark, (5, "back", "INSERT")))
    assert state(table) == bag([(None, "n"), (5, "back")])


def test_markers_stay_few(spark, table, monkeypatch):
    monkeypatch.setattr(partitioned, "MARKERS", 3)
    for n in range(1, 7):
        table.merge(n, change(spark, (n, "x", "UPDATE")))
    assert len(paths.child_names(spark, f"{table.path}/commits")) == 3 and table.version() == 6
    assert table.read_changes(1).count() == 12 and table.commit_row().n_update == 1


def test_the_touched_rows_are_scanned_once(spark, table):
    """The classified rows of a merge come from one scan of the table."""
    source = paths.stage(change(spark, (1, "x", "UPDATE"), (99, "y", "INSERT")))
    seen = merge_module.classify(table.read(), source, "k")
    text = seen._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2  # the table and the change set
    marked = paths.stage(seen)
    state = marked.where(merge_module.stays()).select("k", "v")
    added = merge_module.new_rows(marked.where("__act IS NOT NULL"), source, "k")
    want = merge_module.merge(table.read(), source, "k")
    assert bag(state.unionByName(added.select("k", "v")).collect()) == bag(want.collect())


# -- guards and tombstones -------------------------------------------------------------------------

SCHEMA = "k int, v string, o int, _operation string, b int"


def guarded(spark, root, name, feed, batch, keep):
    t = PartitionedTable(spark, f"{root}/{name}", "k", partitions=4)
    ingest = BronzeIngest(t, StructType.fromDDL(SCHEMA), "o", batch=batch, guard="o", keep_deleted=keep)
    ingest.bootstrap(spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", None)], "k int, v string, o int"))
    landed = [[x for x in feed if x[4] == b] for b in sorted({x[4] for x in feed})]
    for part in [feed] if batch else landed:
        spark.createDataFrame(part, SCHEMA).write.mode("append").parquet(f"{root}/cdc_{name}")
        ingest.run(f"{root}/cdc_{name}")
    return bag(t.read().collect()), bag(t.read_deleted().select("k", "o").collect())


def test_late_updates_do_not_bring_deleted_rows_back(spark, root):
    feed = [(1, None, 9, "DELETE", 1), (1, "late", 7, "UPDATE", 2), (2, "late", 4, "DELETE", 1), (7, None, 6, "DELETE", 1),
            (7, "late", 3, "INSERT", 2), (7, "new", 8, "INSERT", 3), (3, None, None, "DELETE", 2), (3, "x", 1, "INSERT", 3)]
    kept = bag([(2, "b", 5), (7, "new", 8), (3, "x", 1)])
    back = bag([(1, "late", 7), (2, "b", 5), (7, "late", 3), (7, "new", 8), (3, "x", 1)])
    assert guarded(spark, root, "kept", feed, None, "true") == (kept, bag([(1, 9)]))
    assert guarded(spark, root, "folded", feed, "b", "true") == (kept, bag([(1, 9)]))
    # Tombstones that the condition lets go are forgotten; without any, a late change comes back.
    assert guarded(spark, root, "short", feed, None, "o > 100")[1] == []
    plain_rows, none = guarded(spark, root, "plain", feed, None, None)
    assert none == [] and plain_rows != kept and str((1, "late", 7)) in str(plain_rows) and back is not None
    assert guarded(spark, root, "plain_folded", feed, "b", None)[0] == plain_rows


@pytest.mark.parametrize("keep", [None, "true"])
def test_folded_guard_equals_batches_in_turn(spark, root, keep):
    rng = np.random.default_rng(8)
    feed = []
    for b in range(1, 6):
        for k in set(rng.integers(0, 8, 6).tolist()) | {1}:
            o = None if rng.random() < 0.1 else int(rng.integers(0, 12))
            feed.append((int(k), f"{b}", o, str(rng.choice(["INSERT", "UPDATE", "DELETE"])), b))
    assert guarded(spark, root, "turn", feed, None, keep) == guarded(spark, root, "fold", feed, "b", keep)


def test_deleted_keys_need_a_guard(spark, root):
    with pytest.raises(ValueError, match="remembered"):
        BronzeIngest(PartitionedTable(spark, root, "k"), StructType.fromDDL(SCHEMA), "o", keep_deleted="true")
