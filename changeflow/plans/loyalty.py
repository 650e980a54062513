"""The loyalty-programme tables: three keyed tables fed by change files, four derived from them.

    clientes           -> clientes            projection
    transacoes         -> transacoes          projection
    transacao_produto  -> transacao_produto   projection
    transacao_produto  -> produtos            distinct products
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from changeflow.sources.partitioned import PartitionedTable
from changeflow.streaming.ingest import BronzeIngest, DistinctIngest, SilverIngest

METADATA = "_extracted_at string, _load_type string, _operation string"

# Declared columns of the input files.
CLIENTES = (
    "idCliente string, flEmail bigint, flTwitch bigint, flYouTube bigint, flBlueSky bigint, "
    "flInstagram bigint, qtdePontos bigint, DtCriacao string, DtAtualizacao string"
)
TRANSACOES = (
    "IdTransacao string, IdCliente string, DtCriacao string, QtdePontos bigint, DescSistemaOrigem string"
)
TRANSACAO_PRODUTO = (
    "idTransacaoProduto string, IdTransacao string, IdProduto string, QtdeProduto bigint, vlProduto bigint"
)


@dataclass(frozen=True)
class Bronze:
    columns: str
    key: str
    order: tuple[str, ...]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(f"{self.columns}, {METADATA}")


# A client's own update date rarely changes between extractions, so the extraction time follows it.
BRONZE = {
    "clientes": Bronze(CLIENTES, "idCliente", ("DtAtualizacao", "_extracted_at")),
    "transacoes": Bronze(TRANSACOES, "IdTransacao", ("_extracted_at",)),
    "transacao_produto": Bronze(TRANSACAO_PRODUTO, "idTransacaoProduto", ("_extracted_at",)),
}
# The derived tables, as SQL over the rows of their sources.
SILVER_SQL = {
    name: f"SELECT {', '.join(part.split()[0] for part in spec.columns.split(', '))} FROM {{source}}" for name, spec in BRONZE.items()
}
PRODUTOS_SQL = "SELECT IdProduto FROM {source} WHERE IdProduto IS NOT NULL"
SILVER = ("clientes", "transacoes", "transacao_produto", "produtos")


def bronze(spark: SparkSession, root: str, name: str, partitions: int = 256) -> BronzeIngest:
    """However many extractions a run finds, they are applied as if one by one, in one batch."""
    spec = BRONZE[name]
    table = PartitionedTable(spark, f"{root}/bronze/{name}", spec.key, partitions)
    return BronzeIngest(table, spec.schema, spec.order, batch="_extracted_at")


def silver(spark: SparkSession, root: str, name: str, partitions: int = 256) -> SilverIngest | DistinctIngest:
    if name == "produtos":
        source = bronze(spark, root, "transacao_produto").table
        return DistinctIngest(PartitionedTable(spark, f"{root}/silver/produtos", "IdProduto", partitions), source, PRODUTOS_SQL)
    spec = BRONZE[name]
    table = PartitionedTable(spark, f"{root}/silver/{name}", spec.key, partitions)
    return SilverIngest(table, bronze(spark, root, name).table, SILVER_SQL[name])


def run(spark: SparkSession, raw: str, root: str) -> None:
    """Bring all tables up to date from ``raw/full_load/<name>`` and ``raw/cdc/<name>``.

    The keyed tables do not depend on each other, nor do the derived ones: their jobs share the cluster.
    """
    with ThreadPoolExecutor(len(SILVER)) as pool:
        list(pool.map(lambda n: bronze(spark, root, n).execute(f"{raw}/full_load/{n}", f"{raw}/cdc/{n}"), BRONZE))
        list(pool.map(lambda n: silver(spark, root, n).run(), SILVER))
