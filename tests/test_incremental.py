"""Digests, exact samples, extraction from a position, merged profiles, projections from SQL text."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.operators import checks, pending
from changeflow.operators.derive import changes_by_query, derived_changes
from changeflow.operators.diff import snapshot_diff
from changeflow.operators.digest import compared, digest_diff
from changeflow.operators.sample import exact_sample
from changeflow.operators.seek import Extraction
from changeflow.sources import paths
from changeflow.sources.partitioned import PartitionedTable
from changeflow.streaming.ingest import BronzeIngest, SilverIngest
from tests.test_merge import bag


def test_digests_find_the_ranges_that_differ(spark):
    rows = [(k, f"v{k}") for k in range(100)] + [(None, "n"), (7, "v7")]
    a = spark.createDataFrame(rows, "k int, v string").repartition(5)
    other = [(k, "x" if k == 42 else v) for k, v in rows if k != 55] + [(210, "new")]
    b = spark.createDataFrame(other, "k int, v string").repartition(3)
    by = F.expr("k div 10")
    found = {r._range: (r.n_before, r.n_after, r.same) for r in compared(a, b, by).collect()}
    assert {k for k, x in found.items() if not x[2]} == {4, 5, 21}
    assert found[None] == (1, 1, True) and found[5] == (10, 9, False) and found[21] == (0, 1, False)
    assert all(r.same for r in compared(a, a.repartition(7), by).collect())
    for ranges in (1, 16):
        assert bag(digest_diff(a, b, "k", ranges).collect()) == bag(snapshot_diff(a, b, "k").collect())
    assert digest_diff(a, a, "k").count() == 0


@pytest.mark.parametrize("rate, n", [(0.0, 1), (0.001, 1), (0.25, 250), (0.9999, 999), (1.0, 1000)])
def test_samples_have_their_exact_size(spark, rate, n):
    rows = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("h"))
    sample = exact_sample(rows, F.col("h"), 100_000, rate)
    want = sorted((r.h, r.id) for r in rows.collect())[:n]
    assert sorted((r.h, r.id) for r in sample.collect()) == want


def test_samples_of_ties_and_small_tables(spark):
    same = spark.createDataFrame([(5, k // 3) for k in range(30)] + [(None, 1)], "h int, k int")
    assert sorted(r.k for r in exact_sample(same, F.col("h"), 10, 0.5, ["k"]).where("h IS NOT NULL").collect()) == [k // 3 for k in range(14)]
    assert exact_sample(same.where("k < 0"), F.col("h"), 10, 0.5).count() == 0
    assert exact_sample(same.limit(2), F.col("h"), 10, 0.1, least=5).count() == 2


def test_extraction_equals_the_anti_join(spark, root):
    rng = np.random.default_rng(1)
    every = [(k, None if k % 17 == 0 else int(rng.integers(0, 40))) for k in range(300)]
    seek = Extraction(spark, f"{root}/seek", "k", "d", F.expr("d div 5"))
    emitted, there = [], [r for r in every if r[0] % 3]
    for turn in range(8):
        rows = spark.createDataFrame(there, "k int, d int")
        known = spark.createDataFrame([(str(k),) for k in emitted], f"{pending.KEY} string")
        want = pending.next_batch(rows, known, "k", ["d", "k"], 45)
        got = seek.next_batch(rows, 45)
        assert bag(got.collect()) == bag(want.collect()), turn
        emitted += [r.k for r in got.collect()]
        if turn == 2:
            there = every  # late rows arrive
    assert sorted(emitted) == list(range(300)) and seek.runs() == 8


def test_a_run_that_died_is_done_again(spark, root, monkeypatch):
    rows = spark.createDataFrame([(k, k % 4) for k in range(20)], "k int, d int")
    seek = Extraction(spark, root, "k", "d", F.col("d"))
    first = bag(seek.next_batch(rows, 5).collect())
    exists = paths.exists
    paths.delete(spark, f"{root}/place/_run=1/_SUCCESS")
    assert exists(spark, f"{root}/keys/_run=1") and seek.runs() == 0
    assert bag(seek.next_batch(rows, 5).collect()) == first
    assert len({tuple(r) for r in seek.next_batch(rows, 15).collect()}) == 15 and seek.pending(rows).count() == 0


def test_profiles_of_landings_add_up(spark):
    rows = spark.range(3000).selectExpr(
        "id AS key", "id % 7 AS few", "IF(id % 2 = 0, string(id), NULL) AS half", "string(date_add(DATE'2024-01-01', int(id % 90))) AS day"
    )
    parts = [checks.profile_part(rows.where(F.col("key") % 3 == n)) for n in range(3)]
    found = {r.column: r for r in checks.merged_profile(parts[0].union(parts[1]).union(parts[2])).collect()}
    assert {c: (r.n_rows, r.n_values) for c, r in found.items()} == {"key": (3000, 3000), "few": (3000, 3000), "half": (3000, 1500), "day": (3000, 3000)}
    assert (found["key"].n_dates, found["day"].n_dates) == (0, 3000)
    assert [c for c, r in found.items() if r.maybe_key] == ["key"] and found["day"].maybe_date
    for column, n in (("key", 3000), ("few", 7), ("half", 1500), ("day", 90)):
        assert abs(found[column].approx_distinct - n) <= 0.05 * n + 1


def test_a_projection_from_sql_text_equals_one_from_columns(spark):
    images = [
        (1, 5, "update_preimage", 1), (1, 25, "update_postimage", 1), (2, 30, "insert", 1), (2, 30, "delete", 2), (3, 40, "delete", 1),
        (3, 41, "insert", 3), (4, 50, "update_preimage", 2), (4, 3, "update_postimage", 2), (None, 60, "insert", 1), (5, 70, "insert", 2),
        (6, 22, "update_preimage", 1), (6, 23, "update_postimage", 1), (None, 1, "insert", 2),
    ]
    changes = spark.createDataFrame(images, "k int, v int, _change_type string, _commit_version long")
    text = "SELECT k AS id, v * 2 AS w FROM {source} WHERE v > 20"
    want = derived_changes(changes, "k", [F.col("k").alias("id"), (F.col("v") * 2).alias("w")], F.col("v") > 20)
    assert bag(changes_by_query(changes, "k", text, "id").collect()) == bag(want.collect())


def test_sql_text_and_other_options(spark, root):
    table = PartitionedTable(spark, f"{root}/s", "id")
    with pytest.raises(ValueError, match="SQL text"):
        SilverIngest(table, table, "SELECT * FROM {source}", where=F.col("a") > 1)
    schema = "k int, v int, o int, _operation string"
    bronze = BronzeIngest(PartitionedTable(spark, f"{root}/b", "k", 3), StructType.fromDDL(schema), "o")
    bronze.bootstrap(spark.createDataFrame([(1, 1, 0, None), (2, 9, 0, None)], schema))
    silver = SilverIngest(PartitionedTable(spark, f"{root}/silver", "id", 3), bronze.table, "SELECT k AS id, v FROM {source} WHERE v > 5")
    silver.bootstrap()
    spark.createDataFrame([(1, 8, 1, "UPDATE"), (2, 3, 1, "UPDATE"), (3, 7, 1, "INSERT")], schema).write.parquet(f"{root}/cdc")
    bronze.run(f"{root}/cdc")
    silver.run()
    assert bag(silver.table.read().collect()) == bag([(1, 8), (3, 7)])


def test_a_hot_key_among_pending_rows_is_split(spark):
    """No aggregate stands on the right side of the joins with emitted keys."""
    rows, emitted = spark.range(10).withColumnRenamed("id", "k"), spark.createDataFrame([("1",), ("1",)], f"{pending.KEY} string")
    for found, n in ((pending.pending_rows(rows, emitted, "k"), 9), (pending.emitted_rows(rows, emitted, "k"), 1)):
        assert found.count() == n and "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text", ["SELECT k AS id, v * 2 AS w FROM {source} WHERE v > 20", "SELECT k AS id, v * 2 AS w FROM {source}"])
def test_one_commit_of_a_projection_from_sql_text(spark, text):
    images = [
        (1, 5, "update_preimage"), (1, 25, "update_postimage"), (2, 30, "insert"), (3, 40, "delete"), (4, 50, "update_preimage"),
        (4, 3, "update_postimage"), (None, 60, "insert"), (6, 22, "update_preimage"), (6, 23, "update_postimage"), (None, 1, "insert"),
        (7, 1, "delete"), (8, 2, "insert"), (9, 21, "update_preimage"), (9, 9, "update_preimage"), (9, 44, "update_postimage"),
        (9, 44, "update_postimage"),
    ]
    changes = spark.createDataFrame([(*i, 1) for i in images], "k int, v int, _change_type string, _commit_version long")
    got = changes_by_query(changes, "k", text, "id", one_commit=True)
    assert bag(got.collect()) == bag(changes_by_query(changes, "k", text, "id").collect())
    assert "WHERE" in text or "Exchange" not in got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
