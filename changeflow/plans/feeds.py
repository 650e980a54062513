"""Snapshots and change feeds derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.columns import iso_text
from changeflow.operators.latest import latest

FEED_ORDER = ["ts", "event_id"]
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
SNAPSHOT_YEAR = 1997


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _operation(kind: str, insert: str, delete: str) -> Column:
    return F.when(F.col(kind) == insert, "INSERT").when(F.col(kind) == delete, "DELETE").otherwise("UPDATE")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as balance changes; the factor spreads users over customers and absent keys."""
    return load(spark, sf_dir, "events").select(
        (F.col("user_id") * 20).alias("k"),
        F.col("value").alias("v"),
        _operation("event_type", "signup", "error").alias("_operation"),
        "ts",
        "event_id",
        F.dayofmonth("ts").alias("b"),
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with all their columns."""
    return load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")


def customer_rows_feed(spark: SparkSession, sf_dir: str, operation: Column | None = None) -> DataFrame:
    """Events as changes of whole customer rows."""
    operation = _operation("event_type", "signup", "error") if operation is None else operation
    return load(spark, sf_dir, "events").select(
        (F.col("user_id") * 20).alias("k"),
        F.concat(F.lit("Event#"), F.col("event_id").cast("string")).alias("c_name"),
        (F.col("event_id") % 25).cast("int").alias("c_nationkey"),
        F.col("value").alias("c_acctbal"),
        F.upper("event_type").alias("c_mktsegment"),
        operation.alias("_operation"),
        *FEED_ORDER,
        F.dayofmonth("ts").alias("b"),
    )


def weekly(feed: DataFrame) -> DataFrame:
    return feed.withColumn("b", F.expr("(b - 1) div 7 + 1").cast("int"))


def lines(spark: SparkSession, sf_dir: str, each_line: bool = False) -> DataFrame:
    """Order lines as the product an order holds; each later line of an order is a change. With ``each_line``, a line is a
    row of its own and keeps its product beside those of the order's other lines."""
    key = _line_text() if each_line else F.col("l_orderkey")
    return load(spark, sf_dir, "lineitem").select(
        key.alias("k"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        _operation("l_returnflag", "N", "R").alias("_operation"),
        F.year("l_shipdate").alias("b"),
        *LINE_ORDER,
    )


def split_lines(spark: SparkSession, sf_dir: str, each_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The line table as it stood at the end of the snapshot year, and the changes after it."""
    feed = lines(spark, sf_dir, each_line)
    stored = load(spark, sf_dir, "lineitem").where(F.year("l_shipdate") <= SNAPSHOT_YEAR)
    if each_line:
        before = _latest_lines(stored).withColumn("k", _line_text())
    else:
        before = latest(stored.select("l_orderkey", *LINE_ORDER), "l_orderkey", LINE_ORDER).withColumn("k", F.col("l_orderkey"))
    before = before.select("k", F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"))
    return before, feed.where(F.col("b") > SNAPSHOT_YEAR)


def _line_text() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _latest_lines(stored: DataFrame, *ties: Column) -> DataFrame:
    """The latest row per text of ``_line_text``, which is made of what is left: rows are told apart by its numbers, which sort
    and travel faster. The text leaves out a NULL, so a number alone is the same text whichever column it stands in."""
    numbers = {
        "__first": F.coalesce("l_orderkey", "l_linenumber"),
        "__second": F.when(F.col("l_orderkey").isNotNull(), F.col("l_linenumber")),
    }
    rows = stored.select("l_orderkey", *LINE_ORDER, *ties).withColumns(numbers)
    return latest(rows, list(numbers), LINE_ORDER).drop(*numbers)


# -- the same tables in the shape of the loyalty files -------------------------------------------


def clientes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("idCliente"),
        *[
            (F.col("c_mktsegment") == segment).cast("bigint").alias(flag)
            for flag, segment in [
                ("flEmail", "HOUSEHOLD"),
                ("flTwitch", "MACHINERY"),
                ("flYouTube", "FURNITURE"),
                ("flBlueSky", "BUILDING"),
                ("flInstagram", "AUTOMOBILE"),
            ]
        ],
        F.floor("c_acctbal").alias("qtdePontos"),
        F.lit("2023-12-31").alias("DtCriacao"),
        F.lit("2023-12-31").alias("DtAtualizacao"),
    )


def clientes_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = load(spark, sf_dir, "events").select(
        (F.col("user_id") * 20).cast("string").alias("idCliente"),
        *[
            (F.col("event_type") == kind).cast("bigint").alias(flag)
            for flag, kind in [
                ("flEmail", "click"),
                ("flTwitch", "view"),
                ("flYouTube", "purchase"),
                ("flBlueSky", "signup"),
                ("flInstagram", "error"),
            ]
        ],
        F.floor("value").alias("qtdePontos"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("DtCriacao"),
        F.col("ts").cast("string").alias("DtAtualizacao"),
        _operation("event_type", "signup", "error").alias("_operation"),
        F.dayofmonth("ts").alias("b"),
    )
    return weekly(feed)


def transacoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("IdTransacao"),
        F.col("o_custkey").cast("string").alias("IdCliente"),
        iso_text(F.col("o_orderdate")).alias("DtCriacao"),
        F.floor("o_totalprice").alias("QtdePontos"),
        F.col("o_orderpriority").alias("DescSistemaOrigem"),
    )


def transacoes_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("IdTransacao"),
        F.col("l_suppkey").cast("string").alias("IdCliente"),
        iso_text(F.col("l_shipdate")).alias("DtCriacao"),
        F.floor("l_extendedprice").alias("QtdePontos"),
        F.col("l_linestatus").alias("DescSistemaOrigem"),
        _operation("l_returnflag", "N", "R").alias("_operation"),
        F.year("l_shipdate").alias("b"),
    )


def _item_texts() -> list[Column]:
    return [
        _line_text().alias("idTransacaoProduto"),
        F.col("l_orderkey").cast("string").alias("IdTransacao"),
        F.col("l_partkey").cast("string").alias("IdProduto"),
    ]


def _item_numbers() -> list[Column]:
    return [F.col("l_quantity").cast("bigint").alias("QtdeProduto"), F.floor("l_extendedprice").alias("vlProduto")]


def transacao_produto(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = load(spark, sf_dir, "lineitem").where(F.year("l_shipdate") <= SNAPSHOT_YEAR)
    return _latest_lines(stored, *_item_numbers()).select(*_item_texts(), "QtdeProduto", "vlProduto")


def transacao_produto_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").where(F.year("l_shipdate") > SNAPSHOT_YEAR).select(
        *_item_texts(),
        *_item_numbers(),
        _operation("l_returnflag", "N", "R").alias("_operation"),
        F.year("l_shipdate").alias("b"),
    )
