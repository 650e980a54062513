"""Commits, versions and repeats of a keyed table."""

import pytest

from changeflow.operators.merge import apply_changes
from changeflow.sources import paths
from changeflow.sources import table as table_module
from changeflow.sources.table import KeyedTable
from tests.test_merge import bag

BASE = [(k, f"v{k}") for k in range(20)] + [(None, "n")]
OPS = "k int, v string, _operation string"


@pytest.fixture
def table(spark, root):
    t = KeyedTable(spark, f"{root}/t", "k")
    t.overwrite(spark.createDataFrame(BASE, "k int, v string"))
    return t


def change(spark, *rows):
    return spark.createDataFrame(list(rows), OPS)


def state(table, version=None):
    return bag(table.read(version).collect())


def test_bootstrap(spark, root, table):
    assert table.version() == 0 and table.exists()
    assert state(table) == bag(BASE)
    assert table.commit_row().n_rows == 21
    assert not KeyedTable(spark, f"{root}/none", "k").exists()
    with pytest.raises(ValueError):
        table.overwrite(spark.createDataFrame(BASE, "k int, v string"))


def test_versions_changes_and_full_states(spark, table):
    model = {k: v for k, v in BASE}
    history = [bag(model.items())]
    for n in range(1, 7):
        table.merge(n, change(spark, (n, f"u{n}", "UPDATE"), (n + 10, None, "DELETE"), (100 + n, "i", "INSERT")))
        model[n] = f"u{n}"
        model.pop(n + 10)
        model[100 + n] = "i"
        history.append(bag(model.items()))
    # A table opened anew sees every version alike.
    fresh = KeyedTable(spark, table.path, "k")
    for n in range(7):
        assert state(fresh, n) == history[n]
    counts = {(r._commit_version, r._change_type): r["count"]
              for r in fresh.read_changes(2, 3).groupBy("_commit_version", "_change_type").count().collect()}
    assert counts == {(v, t): 1 for v in (2, 3) for t in ("insert", "delete", "update_preimage", "update_postimage")}
    assert fresh.read_changes(0).count() == 24
    assert fresh.read_changes(7).count() == 0
    for first, last in ((8, None), (2, 7)):
        with pytest.raises(ValueError):
            fresh.read_changes(first, last)
    assert [fresh.commit_row(n).n_rows for n in range(7)] == [21] * 7


def test_keyed_read(spark, table):
    table.merge(1, change(spark, (1, "x", "UPDATE"), (50, "y", "INSERT"), (2, None, "DELETE")))
    keys = spark.createDataFrame([(1,), (2,), (3,), (50,), (51,), (None,)], "k int")
    assert bag(table.read_keys(keys).collect()) == bag([(1, "x"), (3, "v3"), (50, "y")])


def test_keys_of_another_type_meet_their_rows(spark, table):
    rows = spark.createDataFrame([("1", "x", "UPDATE"), ("2", None, "DELETE")], "k string, v string, _operation string")
    table.merge(1, rows)
    assert table.commit_row().n_update == 1 and table.commit_row().n_delete == 1
    keys = spark.createDataFrame([(1,), (3,)], "k long")
    assert bag(table.read_keys(keys).collect()) == bag([(1, "x"), (3, "v3")])


def test_repeat_and_gap(spark, table):
    table.merge(1, change(spark, (1, "x", "UPDATE")))
    table.merge(1, change(spark, (1, "other", "UPDATE")))
    assert (1, "x") in [tuple(r) for r in table.read().collect()]
    with pytest.raises(ValueError):
        table.merge(3, change(spark, (1, "x", "UPDATE")))


@pytest.mark.parametrize("lost", ["changes", "state", "commit"])
def test_crash_inside_a_commit(spark, table, monkeypatch, lost):
    """A commit that dies at any step is not visible, and doing it again gives the right table."""
    rows = change(spark, *[(k, f"x{k}", "UPDATE") for k in range(10)], (30, "y", "INSERT"))

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if lost == "changes":
            m.setattr(table_module, "row_changes", die)
        elif lost == "state":
            m.setattr(KeyedTable, "_write_state", die)
        else:
            m.setattr(KeyedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            table.merge(1, rows)
    assert table.version() == 0 and state(table) == bag(BASE) and table.read_changes(1).count() == 0
    table.merge(1, rows)
    want = bag([(k, f"x{k}" if k is not None and k < 10 else v) for k, v in BASE] + [(30, "y")])
    assert state(table) == want
    assert table.read_changes(1).count() == 21


def test_rows_without_key_accumulate(spark, table):
    for n in range(1, 4):
        table.merge(n, change(spark, (None, f"n{n}", "UPDATE")))
    assert bag(table.read().where("k IS NULL").collect()) == bag([(None, "n"), (None, "n1"), (None, "n2"), (None, "n3")])


def test_key_touched_by_several_commits(spark, table):
    table.merge(1, change(spark, (30, "a", "INSERT"), (1, None, "DELETE")))
    table.merge(2, change(spark, (30, "b", "UPDATE"), (1, "again", "UPDATE"), (2, "x", "UPDATE")))
    table.merge(3, change(spark, (30, None, "DELETE"), (2, None, "DELETE")))
    table.merge(4, change(spark, (30, "c", "INSERT"), (1, "kept", "INSERT")))
    want = {k: v for k, v in BASE}
    want.update({30: "c", 1: "again"})
    want.pop(2)
    assert state(table) == bag(want.items())
    # The changes of all commits lead from the first state to the last one.
    assert bag(apply_changes(table.read(0), table.read_changes(1), "k").collect()) == bag(want.items())


def test_repeated_key_in_a_change_set_is_refused(spark, table):
    with pytest.raises(ValueError, match="2 rows for one key"):
        table.merge(1, change(spark, (1, "x", "UPDATE"), (1, "y", "UPDATE")))
    assert table.version() == 0 and state(table) == bag(BASE)
    table.merge(1, change(spark, (None, "x", "INSERT"), (None, "y", "INSERT")))
    assert table.commit_row().n_insert == 2


def test_only_the_newest_states_are_kept(spark, root, table):
    short = KeyedTable(spark, table.path, "k", keep=2)
    for n in range(1, 5):
        short.merge(n, change(spark, (n, "x", "UPDATE")))
    assert sorted(paths.partition_values(spark, f"{table.path}/state", "version")) == ["3", "4"]
    assert bag(short.read().where("v = 'x'").collect()) == bag([(n, "x") for n in range(1, 5)])
    assert short.read_changes(1).count() == 8


def test_emptied_table(spark, table):
    table.merge(1, change(spark, *[(k, None, "DELETE") for k in range(20)]))
    assert state(table) == bag([(None, "n")])
    table.merge(2, change(spark, (5, "back", "INSERT")))
    assert state(table) == bag([(None, "n"), (5, "back")])


def test_scratch_follows_the_session(spark):
    assert paths.new_scratch(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
