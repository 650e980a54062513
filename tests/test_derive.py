"""Random histories: a table, its projection and its distinct values stay in step."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators.derive import derived_changes
from changeflow.operators.distinct import count_row_changes, value_counts, value_deltas
from changeflow.operators.latest import latest
from changeflow.sources import paths
from changeflow.sources.table import KeyedTable
from tests.test_merge import bag

KEYS = st.one_of(st.none(), st.integers(0, 30))
VALUES = st.one_of(st.none(), st.integers(0, 4))
OPS = st.sampled_from(["INSERT", "UPDATE", "UPDATE", "DELETE", None])
BATCH = st.lists(st.tuples(KEYS, VALUES, st.integers(0, 9), OPS), min_size=1, max_size=40)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(KEYS, VALUES, st.integers(0, 9)), min_size=1, max_size=40), st.lists(BATCH, min_size=2, max_size=3))
def test_projection_and_distinct_follow(spark, base, batches):
    root = paths.new_scratch(spark)
    source = KeyedTable(spark, f"{root}/source", "k")
    source.overwrite(spark.createDataFrame(base, "k int, v int, o int"))
    columns, where = [F.col("k").alias("id"), (F.col("v") * 10).alias("ten")], F.col("v") >= 2
    projection = KeyedTable(spark, f"{root}/projection", "id")
    projection.overwrite(source.read().where(where).select(*columns))
    counts = KeyedTable(spark, f"{root}/counts", "v")
    counts.overwrite(value_counts(source.read(), "v"))
    for n, rows in enumerate(batches, 1):
        feed = spark.createDataFrame(rows, "k int, v int, o int, _operation string")
        source.merge(n, latest(feed, "k", "o", "_operation"))
    # All commits fall into one batch of the derived tables.
    changes = source.read_changes(1)
    projection.commit(1, derived_changes(changes, "k", columns, where))
    deltas = paths.stage(value_deltas(changes, "v"))
    counts.commit(1, count_row_changes(counts.read_keys(deltas), deltas, "v"))
    rows = source.read()
    assert bag(projection.read().collect()) == bag(rows.where(where).select(*columns).collect())
    assert projection.commit_row().n_rows == projection.read().count()
    assert bag(counts.read().collect()) == bag(value_counts(rows, "v").collect())
    assert source.commit_row().n_rows == rows.count()
