"""Every registered query against its SQL."""

import importlib

import pytest
from pyspark.sql import functions as F

from changeflow.plans.catalogue import QUERIES
from changeflow.plans.oracles import ORACLES

from tests.oracle import connect, oracle_rows, spark_rows

SF = "/root/testdata/sf0.001"
ENTRY = importlib.import_module("__spark_entry__")
# Those of the optional corpus operators have tests of their own.


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(ENTRY.queries()) and set(ORACLES) <= set(ENTRY.oracle_sql())


def test_entry(spark):
    assert ENTRY.entry(spark).columns == ["c_custkey", "c_acctbal"]


def test_products_of_each_line_are_kept(spark, root):
    """An order's lines are rows of their own: a product that stands on one of several lines isn't lost."""
    given = spark.read.parquet(f"{SF}/lineitem.parquet").limit(1)
    lines = spark.createDataFrame([(1, 1, 10, 1996), (1, 2, 20, 1997), (2, 1, 30, 1998)], "o long, n int, p long, y int")
    made = {"l_orderkey": "o", "l_linenumber": "n", "l_partkey": "p", "l_shipdate": F.make_date("y", F.lit(1), F.lit(1))}
    made = {c: F.col(v) if isinstance(v, str) else v for c, v in made.items()} | {"l_returnflag": F.lit("A")}
    kinds = dict(given.dtypes)
    rows = given.drop(*made).crossJoin(lines).withColumns({c: v.cast(kinds[c]) for c, v in made.items()})
    rows.select(*given.columns).write.parquet(f"{root}/lineitem.parquet")
    found = ENTRY.queries()["distinct_line_products_maintained"](spark, root)
    assert {r.p for r in found.collect()} == {10, 20, 30}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(ENTRY.queries()[name](spark, SF)) == oracle_rows(con, ENTRY.oracle_sql()[name])
