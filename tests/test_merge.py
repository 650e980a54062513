"""The outcome table of the merge, cell by cell."""

import pytest
from pyspark.sql import functions as F

from changeflow.functions.columns import REPLACE
from changeflow.operators.latest import latest, latest_row_changes
from changeflow.operators.merge import LATEST_WINS, REFERENCE, apply_changes, merge, row_changes

TARGET = [(1, "a"), (2, "b"), (3, "c"), (None, "n"), (4, "d"), (4, "d")]
PRE, POST = "update_preimage", "update_postimage"

# change rows (key, op, value, order) -> rows that replace those of the touched keys, row changes
CASES = {
    "insert on match": ([(1, "INSERT", "x", 1)], {1: ["a"]}, []),
    "insert new": ([(9, "INSERT", "x", 1)], {9: ["x"]}, [(9, "x", "insert")]),
    "update on match": ([(2, "UPDATE", "x", 1)], {2: ["x"]}, [(2, "b", PRE), (2, "x", POST)]),
    "update new": ([(9, "UPDATE", "x", 1)], {9: ["x"]}, [(9, "x", "insert")]),
    "delete on match": ([(3, "DELETE", None, 1)], {3: []}, [(3, "c", "delete")]),
    "delete absent": ([(9, "DELETE", None, 1)], {9: []}, []),
    "null and unknown": ([(1, None, "x", 1), (2, "FOO", "x", 1), (9, None, "x", 1)], {1: ["a"], 2: ["b"], 9: []}, []),
    "null key": ([(None, "UPDATE", "x", 1)], {None: ["n", "x"]}, [(None, "x", "insert")]),
    "null key delete": ([(None, "DELETE", "x", 1)], {None: ["n"]}, []),
    "duplicate target key": (
        [(4, "UPDATE", "x", 1)],
        {4: ["x", "x"]},
        [(4, "d", PRE), (4, "d", PRE), (4, "x", POST), (4, "x", POST)],
    ),
    "duplicate target key deleted": ([(4, "DELETE", "x", 1)], {4: []}, [(4, "d", "delete"), (4, "d", "delete")]),
    "several operations": ([(1, "UPDATE", "x", 1), (1, "DELETE", None, 2)], {1: []}, [(1, "a", "delete")]),
    "tie on order": ([(1, "UPDATE", "x", 1), (1, "DELETE", None, 1)], {1: []}, [(1, "a", "delete")]),
    "tie below delete": ([(1, "INSERT", "y", 1), (1, "UPDATE", "x", 1)], {1: ["x"]}, [(1, "a", PRE), (1, "x", POST)]),
    "order null is oldest": ([(1, "UPDATE", "x", 1), (1, "DELETE", None, None)], {1: ["x"]}, [(1, "a", PRE), (1, "x", POST)]),
    "delete then insert": ([(1, "DELETE", None, 1), (1, "INSERT", "x", 2)], {1: ["a"]}, []),
    "update to null": ([(1, "UPDATE", None, 1)], {1: [None]}, [(1, "a", PRE), (1, None, POST)]),
    "replace duplicates": ([(4, REPLACE, "x", 1)], {4: ["x"]}, [(4, "d", PRE), (4, "d", PRE), (4, "x", POST)]),
    "replace absent": ([(9, REPLACE, "x", 1)], {9: ["x"]}, [(9, "x", "insert")]),
}


def bag(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def change_set(spark, rows):
    feed = spark.createDataFrame(rows, "k int, _operation string, v string, o int")
    return latest(feed, "k", "o", "_operation")


def expected(touched):
    kept = [(k, v) for k, v in TARGET if k not in touched]
    return bag(kept + [(k, v) for k, values in touched.items() for v in values])


@pytest.mark.parametrize("case", CASES)
def test_outcomes(spark, case):
    rows, touched, changes = CASES[case]
    target, source = table(spark, TARGET), change_set(spark, rows)
    assert bag(merge(target, source, "k").collect()) == expected(touched)
    found = row_changes(target, source, "k")
    assert bag(found.collect()) == bag(changes)
    committed = found.withColumn("_commit_version", F.lit(1).cast("bigint"))
    for one_commit in (True, False):
        assert bag(apply_changes(target, committed, "k", one_commit).collect()) == expected(touched)


def test_all_cases_in_one_change_set_without_broadcast(spark):
    rows = [(1, "INSERT", "x", 1), (2, "UPDATE", "x", 1), (3, "DELETE", None, 1), (4, "UPDATE", "x", 1),
            (None, "INSERT", "x", 1), (8, "UPDATE", "y", 1), (9, "INSERT", "y", 1), (10, "DELETE", None, 1)]
    want = bag([(1, "a"), (2, "x"), (4, "x"), (4, "x"), (None, "n"), (None, "x"), (8, "y"), (9, "y")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert bag(merge(table(spark, TARGET), change_set(spark, rows), "k").collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_wins_replaces_on_insert(spark):
    target, source = table(spark, TARGET), change_set(spark, [(1, "INSERT", "x", 1), (9, "INSERT", "y", 1)])
    assert (1, "x") in [tuple(r) for r in merge(target, source, "k", mode=LATEST_WINS).collect()]
    assert bag(row_changes(target, source, "k", mode=LATEST_WINS).collect()) == bag(
        [(1, "a", PRE), (1, "x", POST), (9, "y", "insert")]
    )
    with pytest.raises(ValueError):
        merge(target, source, "k", mode="other")


def test_two_batches(spark):
    def run(first, second, guard=None):
        state = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 0)], "k int, v string, o int")
        for rows in (first, second):
            state = merge(state, change_set(spark, rows), "k", mode=REFERENCE, guard=guard)
        return {r.k: r.v for r in state.collect()}

    assert run([(1, "DELETE", None, 1)], [(1, "INSERT", "x", 2)])[1] == "x"
    assert run([(3, "DELETE", None, 1)], [(3, "UPDATE", "x", 2)])[3] == "x"
    late = [(2, "UPDATE", "x", 9)], [(2, "UPDATE", "y", 5)]
    assert run(*late)[2] == "y"
    assert run(*late, guard="o")[2] == "x"
    late_delete = [(2, "UPDATE", "x", 9)], [(2, "DELETE", None, 5)]
    assert run(*late_delete, guard="o")[2] == "x"
    assert run([(2, "UPDATE", "x", 9)], [(2, "UPDATE", "y", 9)], guard="o")[2] == "y"


def test_guard_keeps_whole_keys(spark):
    state = spark.createDataFrame([(1, "old", 1), (1, "new", 9)], "k int, v string, o int")
    source = change_set(spark, [(1, "UPDATE", "x", 5)])
    assert row_changes(state, source, "k", guard="o").count() == 0
    assert merge(state, source, "k", guard="o").count() == 2


def test_composite_key(spark):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, None, "n")], "a int, b int, v string")
    source = spark.createDataFrame(
        [(1, 1, "x", "UPDATE"), (1, 2, None, "DELETE"), (1, None, "y", "UPDATE"), (2, 1, "z", "INSERT")],
        "a int, b int, v string, _operation string",
    )
    got = merge(target, source, ["a", "b"]).collect()
    assert bag(got) == bag([(1, 1, "x"), (1, None, "n"), (1, None, "y"), (2, 1, "z")])


def test_latest_is_total(spark):
    """Rows that tie on everything but the payload: the same row wins whatever the partitioning."""
    rows = [(k % 7, 1, f"v{k}") for k in range(500)]
    picks = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, "k int, o int, v string").repartition(parts)
        picks.add(str(sorted(map(tuple, latest(df, "k", "o").collect()))))
    assert len(picks) == 1


def test_latest_row_change_keeps_rows_without_key(spark):
    changes = spark.createDataFrame(
        [(1, "a", PRE, 1), (1, "b", POST, 1), (1, "b", "delete", 2), (None, "x", "insert", 1), (None, "y", "insert", 2)],
        "k int, v string, _change_type string, _commit_version long",
    )
    got = latest_row_changes(changes, "k").select("k", "v", "_change_type").collect()
    assert bag(got) == bag([(1, "b", "delete"), (None, "x", "insert"), (None, "y", "insert")])
