"""Row changes of all batches in one pass against the batch loop."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.operators.distinct import distinct_values, set_history
from changeflow.operators.history import history
from changeflow.operators.latest import latest
from changeflow.operators.merge import LATEST_WINS, REFERENCE, apply_changes, merge, row_changes
from changeflow.sources.paths import stage
from tests.test_merge import bag
from tests.test_replay import CHANGE, FEED, model, rows

BASE = "k int, v int"


def looped(spark, base, changes, mode):
    """The same by one merge after the other."""
    state, feed, out = spark.createDataFrame(base, BASE), spark.createDataFrame(changes, FEED), []
    for b in sorted({c[4] for c in changes}):
        source = stage(latest(feed.where(f"b = {b}"), "k", "o", "_operation").select("k", "v", "_operation"))
        out += [(*r, b) for r in row_changes(state, source, "k", mode=mode).collect()]
        state = stage(merge(state, source, "k", mode=mode))
    return bag(out), bag(state.collect())


@pytest.mark.parametrize("mode", [REFERENCE, LATEST_WINS])
def test_equals_the_loop(spark, mode):
    base = [(k, k) for k in range(0, 40, 2)] + [(4, 90), (None, 3)]
    changes = [
        (None if k % 37 == 5 else k % 30, ["INSERT", "UPDATE", "DELETE", None][(k * k + k // 7) % 4], k % 9, k % 11, 1 + (k * 13) % 4)
        for k in range(240)
    ]
    target, feed = spark.createDataFrame(base, BASE), spark.createDataFrame(changes, FEED)
    got = history(target, feed, "k", "b", "o", mode=mode)
    expected, state = looped(spark, base, changes, mode)
    assert bag(got.collect()) == expected
    assert bag(apply_changes(target, stage(got), "k").collect()) == state


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 12), st.integers(0, 5)), min_size=1, max_size=20),
    st.lists(CHANGE, min_size=1, max_size=200),
)
def test_every_version_equals_the_model(spark, base, changes):
    target, feed = spark.createDataFrame(base, BASE), spark.createDataFrame(changes, FEED)
    made = stage(history(target, feed, "k", "b", "o"))
    for b in (2, 4, 6):
        state = apply_changes(target, made.where(f"_commit_version <= {b}"), "k")
        assert rows(state) == model(base, [c for c in changes if c[4] <= b], REFERENCE)


def test_sets_by_version(spark):
    base = [(1, 10), (2, 10), (3, 20), (4, None)]
    changes = [(1, "DELETE", None, 1, 1), (2, "DELETE", None, 1, 2), (3, "UPDATE", 10, 1, 3), (4, "UPDATE", 30, 1, 3),
               (4, "UPDATE", 20, 1, 4), (9, "INSERT", 20, 1, 5), (4, "DELETE", None, 1, 5)]
    target, feed = spark.createDataFrame(base, BASE), spark.createDataFrame(changes, FEED)
    found = set_history(target, history(target, feed, "k", "b", "o"), "v")
    assert bag(found.collect()) == bag([
        (10, "delete", 2), (10, "insert", 3), (20, "delete", 3), (30, "insert", 3), (30, "delete", 4), (20, "insert", 4)
    ])


def test_distinct_of_several_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, None), (None, 2), (2, 2)], BASE)
    assert bag(distinct_values(df, ["k", "v"]).collect()) == bag([(1, 2), (2, 2)])


def test_the_table_is_shuffled_by_changed_keys_only(spark):
    target = spark.range(100_000).selectExpr("int(id) AS k", "int(id) AS v")
    feed = spark.createDataFrame([(k, "UPDATE", 1, 1, 1) for k in range(5)], FEED)
    plan = history(target, feed, "k", "b", "o")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
