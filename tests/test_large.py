"""Change sets about as large as the table: one join instead of two, with the rows and row changes of the usual way."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.functions.columns import REPLACE
from changeflow.operators.latest import latest
from changeflow.operators.merge import LATEST_WINS, REFERENCE
from changeflow.operators.replay import _fold
from changeflow.plans import feeds
from changeflow.sources import partitioned
from changeflow.sources.partitioned import PartitionedTable
from changeflow.streaming.ingest import DistinctIngest
from tests.test_merge import bag
from tests.test_plans import plan
from tests.test_replay import FEED

SF = "/root/testdata/sf0.001"
KEYS = 12_000
IMAGE = ("k", "v", "_change_type")


def refuse(*args, **kwargs):
    raise AssertionError("taken the other way")


def numbers(spark, path):
    """Even keys, some of them stored twice, and rows without a key."""
    table = PartitionedTable(spark, path, "k", partitions=16)
    base = spark.range(0, KEYS, 2).selectExpr("int(id) AS k", "int(id) AS v")
    twice = base.where("k % 100 = 0").withColumn("v", F.lit(-1))
    table.overwrite(base.unionByName(twice).unionByName(spark.createDataFrame([(None, 1), (None, 2)], "k int, v int")))
    return table


@pytest.mark.parametrize("mode", [REFERENCE, LATEST_WINS])
def test_a_large_merge_is_one_join(spark, root, monkeypatch, mode):
    ops = F.array(*[F.lit(x) for x in ("INSERT", "UPDATE", "DELETE", REPLACE, "FOO", None)])
    source = spark.range(0, KEYS, 3).selectExpr("int(id) AS k", "int(id) + 1 AS v")
    source = source.withColumn("_operation", ops[F.pmod(F.xxhash64("k"), F.lit(6)).cast("int")])
    keyless = [(None, 5, "INSERT"), (None, 6, REPLACE), (None, 7, "DELETE"), (None, 8, "UPDATE")]
    source = source.unionByName(spark.createDataFrame(keyless, "k int, v int, _operation string"))
    usual, whole = numbers(spark, f"{root}/usual"), numbers(spark, f"{root}/whole")
    with monkeypatch.context() as m:
        m.setattr(PartitionedTable, "_is_even", lambda self, rows: False)
        m.setattr(partitioned, "classify_all", refuse)
        usual.merge(1, source, mode=mode)
    with monkeypatch.context() as m:
        m.setattr(partitioned, "new_rows", refuse)
        whole.merge(1, source, mode=mode, unique=True)
    assert bag(whole.read().collect()) == bag(usual.read().collect())
    assert bag(whole.read_changes(1).select(*IMAGE).collect()) == bag(usual.read_changes(1).select(*IMAGE).collect())
    kinds = {r[0] for r in whole.read_changes(1).select("_change_type").distinct().collect()}
    assert kinds == {"insert", "delete", "update_preimage", "update_postimage"}
    # Each row lies in the partition of its key.
    assert whole.read().count() == sum(whole._rows([p]).where(whole._part(["k", "v"]) == p).count() for p in range(16))


def test_a_frequent_key_and_few_changes_go_the_usual_way(spark, root, monkeypatch):
    monkeypatch.setattr(partitioned, "classify_all", refuse)
    few = numbers(spark, f"{root}/few")
    few.merge(1, spark.createDataFrame([(2, 9, "UPDATE")], "k int, v int, _operation string"))
    hot = PartitionedTable(spark, f"{root}/hot", "k", partitions=16)
    hot.overwrite(spark.range(KEYS).selectExpr("int(if(id % 3 = 0, 0, id)) AS k", "int(id) AS v"))
    hot.merge(1, hot.read().where("k > 0").withColumn("_operation", F.lit("UPDATE")))
    assert hot.read().count() == KEYS


def test_keys_that_a_cast_makes_equal_are_refused(spark, root):
    table = numbers(spark, f"{root}/t")
    source = spark.createDataFrame([("1", 1, "UPDATE"), ("01", 2, "UPDATE")], "k string, v int, _operation string")
    with pytest.raises(ValueError, match="2 rows for one key"):
        table.merge(1, source, unique=True)


def test_many_values_change_their_counts_in_one_join(spark, root, monkeypatch):
    lines = PartitionedTable(spark, f"{root}/lines", "k", partitions=16)
    lines.overwrite(spark.range(2000).selectExpr("int(id) AS k", "int(id % 700) AS p", "int(id % 3) AS s"))
    pairs = DistinctIngest(PartitionedTable(spark, f"{root}/pairs", ["p", "s"], 16), lines)
    pairs.bootstrap()
    changed = lines.read().where("k % 2 = 0").withColumn("p", F.col("k") % 900)
    changed = changed.withColumn("_operation", F.when(F.col("k") % 3 == 0, "DELETE").otherwise("UPDATE"))
    lines.merge(1, changed)
    monkeypatch.setattr(PartitionedTable, "read_keys", refuse)
    pairs.run()
    now = lines.read().groupBy("p", "s").count()
    assert bag(pairs.table.read().collect()) == bag(now.collect())
    assert {r[0] for r in pairs.table.read_changes(1).select("_change_type").distinct().collect()} >= {"insert", "delete"}


def test_the_fold_of_winners_is_one_window(spark):
    winners = spark.createDataFrame([(k, "UPDATE", 1, 1, 1) for k in range(50)], FEED)
    text = plan(_fold(winners, ["k"], "b", "_operation", REFERENCE), "simple")
    assert sum(line.lstrip(" :+-").startswith("Window [") for line in text.split("\n")) == 1


# -- the lines that tests of the loyalty tables and of the offers start from ------------------------


def odd_lines(spark, root):
    """Lines that share a key, some by the text of a number that stands in the other column, with ties and NULLs."""
    given = spark.read.parquet(f"{SF}/lineitem.parquet").limit(1)
    rng = np.random.default_rng(11)
    pick = lambda *values: values[rng.integers(len(values))]
    rows = [
        (pick(None, 1, 2, -5, 12), pick(None, 1, 2, 5), pick(None, 3, 20), pick(7, 8), pick("1996-01-01", "1997-05-05"),
         pick(None, 1.5, 2.5), pick(None, 10.2, 11.0), pick("N", "R", "A", None))
        for _ in range(400)
    ]
    made = spark.createDataFrame(rows, "o long, n int, p long, s long, d string, q double, e double, f string")
    names = {"l_orderkey": "o", "l_linenumber": "n", "l_partkey": "p", "l_suppkey": "s", "l_shipdate": "d", "l_quantity": "q",
             "l_extendedprice": "e", "l_returnflag": "f"}
    kinds = dict(given.dtypes)
    whole = given.drop(*names).crossJoin(made).withColumns({c: F.col(v).cast(kinds[c]) for c, v in names.items()})
    whole.select(*given.columns).write.parquet(f"{root}/lineitem.parquet")


def test_snapshots_are_told_apart_by_numbers(spark, root):
    odd_lines(spark, root)
    order = feeds.LINE_ORDER
    text = F.concat_ws("-", "l_orderkey", "l_linenumber")
    lines = feeds.load(spark, root, "lineitem")
    want = latest(lines.select(text.alias("k"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), *order), "k", order)
    before = feeds.split_lines(spark, root, each_line=True)[0]
    assert bag(before.collect()) == bag(want.select("k", "p", "s").collect())
    items = lines.select(
        text.alias("idTransacaoProduto"), F.col("l_orderkey").cast("string").alias("IdTransacao"),
        F.col("l_partkey").cast("string").alias("IdProduto"), F.col("l_quantity").cast("bigint").alias("QtdeProduto"),
        F.floor("l_extendedprice").alias("vlProduto"), *order,
    )
    want = latest(items, "idTransacaoProduto", order).drop(*order)
    found = feeds.transacao_produto(spark, root)
    assert found.columns == want.columns and bag(found.collect()) == bag(want.collect())
    for df in (before, found):
        shuffled = [line for line in plan(df, "simple").split("\n") if "Exchange hashpartitioning" in line]
        assert shuffled and all("concat_ws" not in line and "__first" in line for line in shuffled)
    orders = latest(lines.select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), *order), "k", order)
    assert bag(feeds.split_lines(spark, root)[0].collect()) == bag(orders.select("k", "p", "s").collect())
