"""One-pass replay against the batch loop and against a dictionary model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.operators.latest import latest
from changeflow.operators.merge import LATEST_WINS, REFERENCE, merge
from changeflow.operators import replay as replay_module
from changeflow.operators.replay import net_changes, replay
from changeflow.sources.paths import stage

RANK = {"DELETE": 3, "UPDATE": 2, "INSERT": 1}
FEED = "k int, _operation string, v int, o int, b int"
OPS = st.sampled_from(["INSERT", "UPDATE", "DELETE", None, "FOO"])
CHANGE = st.tuples(st.integers(0, 40), OPS, st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3), st.integers(1, 6))


def model(base, feed, mode):
    """Rows per key (a key may be stored several times), batch by batch."""
    state = {}
    for k, v in base:
        state.setdefault(k, []).append(v)
    for batch in sorted({c[4] for c in feed}):
        winners = {}
        for k, op, v, o, b in (c for c in feed if c[4] == batch):
            rank = (o, RANK.get(op, 0), v is not None, v if v is not None else 0, op or "")
            if k not in winners or rank > winners[k][0]:
                winners[k] = (rank, op, v)
        for k, (_, op, v) in winners.items():
            if op == "INSERT" and mode == LATEST_WINS:
                op = "UPDATE"
            if op == "DELETE":
                state.pop(k, None)
            elif op == "UPDATE":
                state[k] = [v] * max(1, len(state.get(k, [])))
            elif op == "INSERT" and k not in state:
                state[k] = [v]
    return sorted((k, repr(v)) for k, values in state.items() for v in values)


def rows(df):
    return sorted((r.k, repr(r.v)) for r in df.select("k", "v").collect())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 40), st.integers(0, 5)), min_size=1, max_size=40),
    st.lists(CHANGE, min_size=1, max_size=250),
)
def test_replay_equals_model(spark, base, changes):
    target = spark.createDataFrame(base, "k int, v int")
    feed = spark.createDataFrame(changes, FEED)
    for mode in (REFERENCE, LATEST_WINS):
        assert rows(replay(target, feed, "k", "b", "o", mode=mode)) == model(base, changes, mode)


def test_replay_equals_loop(spark):
    base = [(k, k) for k in range(0, 60, 2)]
    changes = [
        (k % 50, ["INSERT", "UPDATE", "DELETE"][(k * k + k // 7) % 3], k, k % 11, 1 + (k * 13) % 5) for k in range(400)
    ]
    feed = spark.createDataFrame(changes, FEED)
    state = spark.createDataFrame(base, "k int, v int")
    for b in range(1, 6):
        state = stage(merge(state, latest(feed.where(f"b = {b}"), "k", "o", "_operation"), "k"))
    assert rows(state) == rows(replay(spark.createDataFrame(base, "k int, v int"), feed, "k", "b", "o"))
    assert rows(state) == model(base, changes, REFERENCE)


def test_rows_without_key_are_added_per_batch(spark):
    base = spark.createDataFrame([(None, 0), (1, 1)], "k int, v int")
    feed = spark.createDataFrame(
        [(None, "INSERT", 1, 1, 1), (None, "UPDATE", 2, 2, 1), (None, "UPDATE", 3, 1, 2), (None, "DELETE", 4, 1, 3)], FEED
    )
    got = sorted(repr(tuple(r)) for r in replay(base, feed, "k", "b", "o").collect())
    assert got == sorted(map(repr, [(None, 0), (1, 1), (None, 2), (None, 3)]))


def test_feed_columns_stay_as_they_came(spark):
    feed = spark.createDataFrame([(1, "DELETE", 0, 1, 1), (1, "INSERT", 5, 1, 2), (2, "INSERT", 6, 1, 1)], FEED)
    got = {r.k: (r._operation, r.v, r._action) for r in net_changes(feed, "k", "b", "o").collect()}
    assert got == {1: ("INSERT", 5, "__replace__"), 2: ("INSERT", 6, "INSERT")}


@pytest.mark.parametrize("mode", ["reference", "latest_wins"])
def test_changes_without_a_batch_come_first(spark, mode):
    base = spark.createDataFrame([(1, "base"), (2, "base")], "k int, v string")
    feed = spark.createDataFrame(
        [(1, "first", "UPDATE", 1, None), (2, "first", "UPDATE", 1, None), (2, "then", "UPDATE", 1, 1), (3, "in", "INSERT", 1, None),
         (4, None, "DELETE", 1, None), (4, "x", "INSERT", 1, 1)],
        "k int, v string, _operation string, o int, b int",
    )
    got = replay(base, feed, "k", "b", "o", mode=mode)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "first"), (2, "then"), (3, "in"), (4, "x")]


@pytest.mark.parametrize("heavy", [1, 10, 1_000])
def test_keys_are_shuffled_once_unless_they_are_frequent(spark, monkeypatch, heavy):
    """Whichever way a key takes, the outcome is the model's; few rows of a key cost one shuffle and no join."""
    monkeypatch.setattr(replay_module, "HEAVY", heavy)
    often = [(7, ["INSERT", "UPDATE", "DELETE", "FOO"][(i * i + i // 5) % 4], i % 6, i % 4, 1 + i % 9) for i in range(300)]
    seldom = [(k, ["INSERT", "DELETE", "INSERT", "UPDATE"][(k + k // 3) % 4], k, 1, 1 + (k * 7) % 9) for k in range(20, 520)]
    seldom += [(k, ["INSERT", "UPDATE", "DELETE"][k % 3], k + 1, 1, 1 + (k * 5) % 9) for k in range(20, 520, 2)]
    base = [(k, 100 + k) for k in range(0, 600, 3)]
    feed = stage(spark.createDataFrame(often + seldom, FEED))
    for mode in (REFERENCE, LATEST_WINS):
        got = replay(spark.createDataFrame(base, "k int, v int"), feed, "k", "b", "o", mode=mode)
        assert rows(got) == model(base, often + seldom, mode)
    net = net_changes(feed.where("k <> 7") if heavy == 1 else feed, "k", "b", "o")
    text = net._sc._jvm.PythonSQLUtils.explainString(net._jdf.queryExecution(), "simple")
    assert ("Join" in text) == (heavy > 1)
    if heavy == 1:
        assert text.count("Exchange hashpartitioning") == 2  # the second is that of the rows without a key
