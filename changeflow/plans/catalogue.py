"""Registered queries: each takes (spark, sf_dir) and covers one operator on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import SAMPLE_A, SAMPLE_B, SAMPLE_M, file_stamp, in_sample, scale_and_round
from changeflow.functions.schemas import conform, load_schema
from changeflow.operators import checks, pending
from changeflow.operators.digest import compared, digest_diff
from changeflow.operators.diff import snapshot_diff as diff_snapshots
from changeflow.operators.derive import derived_changes, latest_operations, projected_operations
from changeflow.operators.distinct import count_row_changes, distinct_values, set_history, value_counts, value_deltas
from changeflow.operators.guarded import replay_guarded as fold_guarded
from changeflow.operators.history import history
from changeflow.operators.latest import latest, latest_row_changes
from changeflow.operators.merge import LATEST_WINS, REFERENCE, apply_changes, merge, row_changes
from changeflow.operators.replay import replay
from changeflow.operators.sample import exact_sample as sample_exactly
from changeflow.operators.seek import Extraction
from changeflow.plans import feeds, loyalty
from changeflow.plans.feeds import FEED_ORDER, LINE_ORDER, load
from changeflow.sources import files, paths
from changeflow.sources.partitioned import PartitionedTable
from changeflow.sources.table import KeyedTable
from changeflow.streaming.ingest import BronzeIngest, DistinctIngest, SilverIngest

NEXT_BATCH = 500
SAMPLE_RATE = 0.03
PARTITIONS = 16  # of the tables that queries make for themselves


# -- projections, stamps, schemas ------------------------------------------------------------


def silver_projection_clients(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def stamp_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").withColumn("stamp", file_stamp(F.col("o_orderdate")))
    return files.stamp(orders, "2024-01-02T03:04:05", files.FULL_LOAD)


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    schema = StructType.fromDDL(
        "C_CUSTKEY string, c_nationkey bigint, c_acctbal string, c_mktsegment bigint, "
        "c_name string, _operation string"
    )
    customer = load(spark, sf, "customer").withColumn("c_acctbal", F.rint("c_acctbal").cast("bigint"))
    return conform(customer, schema, on_loss="null").withColumnRenamed("C_CUSTKEY", "c_custkey")


def scale_round_restore(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part")
    kinds = dict(part.dtypes)
    return part.withColumns({c: scale_and_round(c, 1.07, kinds[c]) for c in ("p_size", "p_retailprice")})


def date_parse_profile(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("string").alias("date_text"),
        "o_orderpriority",
        "o_orderstatus",
    )
    return checks.profile_columns(orders).select("column", "n_rows", "n_values", "n_dates", "maybe_date")


# -- sources and landing ---------------------------------------------------------------------


def csv_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    path = paths.new_scratch(spark)
    customer.write.csv(path, sep=";", header=True)
    return files.read_delimited(spark, path, customer.schema)


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    path = paths.new_scratch(spark)
    files.land_snapshot(customer.withColumn("c_acctbal", F.col("c_acctbal") - 1), path, "2024-01-01T00:00:00")
    files.land_snapshot(customer, path, "2024-02-01T00:00:00")
    schema = StructType([*customer.schema.fields])
    for name in ("_extracted_at", "_load_type", "_operation"):
        schema = schema.add(name, "string")
    return files.read_snapshot(spark, files.newest_snapshot(spark, path), schema)


def drifting_types(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings of one table that disagree on a column's type."""
    orders = load(spark, sf, "orders")
    whole, drifted = paths.new_scratch(spark), paths.new_scratch(spark)
    orders.where("o_orderstatus = 'F'").write.parquet(whole)
    other = orders.where("o_orderstatus <> 'F'")
    other.withColumn("o_custkey", F.col("o_custkey").cast("double")).drop("o_orderstatus").write.parquet(drifted)
    return files.read_drifting(spark, [whole, drifted], orders.schema)


def schema_document(spark: SparkSession, sf: str) -> DataFrame:
    """The declared columns come from a document beside the data, which has other types and one column less."""
    root = paths.new_scratch(spark)
    declared = StructType.fromDDL("c_custkey string, c_name string, c_acctbal double, c_nationkey bigint, _operation string")
    spark.createDataFrame([(declared.json(),)], "value string").coalesce(1).write.text(f"{root}/schema")
    return conform(load(spark, sf, "customer"), load_schema(spark, f"{root}/schema"))


def _order_table(spark: SparkSession, sf: str, schema: StructType, on_loss: str) -> tuple[BronzeIngest, str]:
    """The orders that are done, as a table; a directory for the changes that follow."""
    root = paths.new_scratch(spark)
    ingest = BronzeIngest(PartitionedTable(spark, f"{root}/orders", "o_orderkey", PARTITIONS), schema, "o_orderdate", on_loss=on_loss)
    ingest.bootstrap(conform(load(spark, sf, "orders").where("o_orderstatus = 'F'"), schema, on_loss="null"))
    return ingest, f"{root}/cdc"


def drifting_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A stream over change files of which one landing has a DOUBLE and a text under a declared bigint, and lacks a column."""
    orders = load(spark, sf, "orders")
    ingest, landing = _order_table(spark, sf, orders.schema.add("_operation", "string"), "raise")
    changes = orders.withColumn("_operation", F.when(F.col("o_orderstatus") == "F", "DELETE").otherwise("INSERT"))
    changes.where("o_orderstatus = 'P' OR o_orderkey % 5 = 0").write.parquet(f"{landing}/landed=1")
    other = changes.where("o_orderstatus = 'O' AND o_orderkey % 5 <> 0").drop("o_orderpriority")
    other.withColumn("o_custkey", F.col("o_custkey").cast("double")).withColumn(
        "o_orderkey", F.col("o_orderkey").cast("string")
    ).write.parquet(f"{landing}/landed=2")
    ingest.run(landing)
    return ingest.table.read().drop("_operation")


def _rejecting(spark: SparkSession, sf: str) -> BronzeIngest:
    """Prices are declared as whole numbers; every tenth landed order has one with its cents."""
    orders = load(spark, sf, "orders")
    schema = StructType([*[f for f in orders.schema.fields if f.name != "o_totalprice"]]).add("o_totalprice", "long").add("_operation", "string")
    ingest, landing = _order_table(spark, sf, schema, "reject")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice")).otherwise(F.floor("o_totalprice").cast("double"))
    changes = orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", price)
    changes.withColumn("_operation", F.lit("INSERT")).write.parquet(landing)
    ingest.run(landing)
    return ingest


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    bad = _rejecting(spark, sf).read_rejected()
    key = F.get_json_object("_row", "$.o_orderkey").cast("bigint").alias("o_orderkey")
    return bad.select(key, F.col("_column").alias("rejected_column"), "_commit_version")


def accepted_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rejecting(spark, sf).table.read().drop("_operation")


# -- latest change, extraction ----------------------------------------------------------------


def latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return latest(load(spark, sf, "events"), "user_id", ["ts", "event_id"])


def latest_line_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


def _emitted(spark: SparkSession, sf: str) -> DataFrame:
    return pending.key_set(load(spark, sf, "events"), "user_id")


def next_pending_batch(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    return pending.next_batch(orders, _emitted(spark, sf), "o_orderkey", ["o_orderdate", "o_orderkey"], NEXT_BATCH)


def emitted_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    return pending.emitted_rows(orders, _emitted(spark, sf), "o_orderkey")


def pending_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    return pending.pending_rows(orders, _emitted(spark, sf), "o_orderkey")


def emitted_key_set(spark: SparkSession, sf: str) -> DataFrame:
    batch = next_pending_batch(spark, sf)
    return pending.extend_key_set(_emitted(spark, sf), batch, "o_orderkey").withColumnRenamed(pending.KEY, "emitted")


def union_change_sets(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    status = F.col("o_orderstatus")
    inserts = orders.where(status == "O").drop("o_orderstatus").withColumn("_operation", F.lit("INSERT"))
    updates = orders.where(status == "F").withColumn("_operation", F.lit("UPDATE"))
    deletes = orders.where(status == "P").select("o_orderkey").withColumn("_operation", F.lit("DELETE"))
    return pending.union_change_sets(inserts, updates, deletes)


def keyed_sample(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").where(in_sample(F.col("o_orderkey"), SAMPLE_RATE))


def _spread(key: str) -> Column:
    return F.pmod(F.pmod(F.col(key), F.lit(SAMPLE_M)) * SAMPLE_A + SAMPLE_B, F.lit(SAMPLE_M))


def exact_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of exactly ``int(rate * rows)`` orders."""
    return sample_exactly(load(spark, sf, "orders"), _spread("o_orderkey"), SAMPLE_M, SAMPLE_RATE, ["o_orderkey"])


def exact_sample_of_one(spark: SparkSession, sf: str) -> DataFrame:
    """At so small a rate still one row."""
    return sample_exactly(load(spark, sf, "supplier"), _spread("s_suppkey"), SAMPLE_M, 1e-9, ["s_suppkey"])


def remembered_pending(spark: SparkSession, sf: str) -> DataFrame:
    """What is pending after two batches whose keys were remembered."""
    orders, memory = load(spark, sf, "orders"), f"{paths.new_scratch(spark)}/keys"
    emitted = spark.createDataFrame([], f"{pending.KEY} string")
    for _ in range(2):
        batch = pending.next_batch(orders, emitted, "o_orderkey", ["o_orderdate", "o_orderkey"], NEXT_BATCH)
        pending.remember(memory, paths.stage(batch), "o_orderkey")
        emitted = spark.read.parquet(memory)
    return pending.pending_rows(orders, emitted, "o_orderkey")


def extractions_in_turn(spark: SparkSession, sf: str) -> DataFrame:
    """Three extractions from a position; some orders arrive after the first one, before its end."""
    orders = load(spark, sf, "orders")
    by = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    seek = Extraction(spark, paths.new_scratch(spark), "o_orderkey", "o_orderdate", by)
    batches = [seek.next_batch(rows, NEXT_BATCH) for rows in (orders.where("o_orderkey % 7 <> 0"), orders, orders)]
    return reduce(DataFrame.unionByName, [b.withColumn("run", F.lit(n)) for n, b in enumerate(batches, 1)])


# -- counts -----------------------------------------------------------------------------------


def op_counts_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return checks.operation_counts(feeds.customer_feed(spark, sf), ["b"])


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A merged table and the filtered projection that is derived from it."""
    bronze = merge_once_rows(spark, sf)
    return checks.layer_counts({"bronze": bronze, "silver": bronze.where("c_acctbal > 20").select(F.col("k").alias("id"))})


def profile_landings(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the orders, profiled landing by landing and then together; which may be key or date."""
    orders = load(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    orders = orders.withColumn("o_clerk", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")))
    landings = [checks.profile_part(orders.where(F.col("o_orderstatus") == status)) for status in ("F", "O", "P")]
    return checks.merged_profile(paths.stage(reduce(DataFrame.unionByName, landings))).drop("approx_distinct")


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    """Which thousands of order numbers differ between two layers, by digests; no rows are joined."""
    orders = load(spark, sf, "orders")
    rare = F.expr("o_orderkey div 1000") % 5 == 0
    changed = F.when(rare & (F.col("o_orderkey") % 100 == 1), "corrected").otherwise(F.col("o_orderpriority"))
    other = orders.where(~(rare & (F.col("o_orderkey") % 500 == 2))).withColumn("o_orderpriority", changed)
    found = compared(orders, other, F.expr("o_orderkey div 1000"))
    return found.withColumnRenamed("_range", "thousand")


# -- merge ------------------------------------------------------------------------------------


def _one_change_set(spark: SparkSession, sf: str) -> DataFrame:
    feed = feeds.customer_feed(spark, sf)
    return paths.stage(latest(feed, "k", FEED_ORDER, "_operation").select("k", "v", "_operation"))


def _change_rows(spark: SparkSession, sf: str, feed: DataFrame | None = None) -> DataFrame:
    """The latest change of each customer, with all columns."""
    feed = feeds.customer_rows_feed(spark, sf) if feed is None else feed
    return paths.stage(latest(feed, "k", FEED_ORDER, "_operation").drop("b", *FEED_ORDER))


def merge_once(spark: SparkSession, sf: str) -> DataFrame:
    return merge(feeds.customers(spark, sf), _one_change_set(spark, sf), "k")


def merge_once_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    return merge(feeds.customer_rows(spark, sf), _change_rows(spark, sf), "k", mode=LATEST_WINS)


def merge_changes(spark: SparkSession, sf: str) -> DataFrame:
    return row_changes(feeds.customer_rows(spark, sf), _change_rows(spark, sf), "k")


def merge_null_and_unknown_ops(spark: SparkSession, sf: str) -> DataFrame:
    """Views come without an operation, purchases with one nobody knows."""
    kind = F.col("event_type")
    operation = (
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").when(kind == "click", "UPDATE")
        .when(kind == "purchase", "REFUND")
    )
    return merge(feeds.customer_rows(spark, sf), _change_rows(spark, sf, feeds.customer_rows_feed(spark, sf, operation)), "k")


def merge_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's newest event of the first half month is stored. One change per user comes in, of any age: newer,
    of equal time, older, or of a user not stored; an older one leaves the row alone, whatever its operation."""
    columns = [c for c in load(spark, sf, "events").columns if c != "user_id"]
    events = load(spark, sf, "events").select(F.col("user_id").alias("k"), *columns)
    stored = latest(events.where(F.dayofmonth("ts") <= 15), "k", FEED_ORDER)
    shuffled = events.withColumn("turn", F.col("event_id") % 7)
    change = latest(shuffled, "k", ["turn", "event_id"]).drop("turn")
    kind = F.col("event_type")
    operation = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE")
    return merge(stored, paths.stage(change.withColumn("_operation", operation)), "k", guard="ts")


def merge_once_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The merge of whole customer rows, all columns."""
    return merge(feeds.customer_rows(spark, sf), _change_rows(spark, sf), "k")


def snapshot_diff_rows(spark: SparkSession, sf: str) -> DataFrame:
    return diff_snapshots(feeds.customer_rows(spark, sf), merge_once_rows(spark, sf), "k")


def snapshot_diff_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The same, of the ranges whose digests differ alone."""
    return digest_diff(feeds.customer_rows(spark, sf), paths.stage(merge_once_rows(spark, sf)), "k", 64)


def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return diff_snapshots(feeds.customers(spark, sf), merge_once(spark, sf), "k")


def snapshot_diff_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines by order, a key that repeats: some lines gone, some doubled, some changed."""
    before = load(spark, sf, "lineitem")
    after = before.where("l_linenumber <> 3").unionByName(before.where("l_linenumber = 1 AND l_returnflag = 'R'"))
    changed = F.when(F.col("l_linenumber") == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return diff_snapshots(before, after.withColumn("l_quantity", changed), "l_orderkey")


# -- replay -----------------------------------------------------------------------------------


def replay_fold(spark: SparkSession, sf: str) -> DataFrame:
    return replay(feeds.customers(spark, sf), feeds.customer_feed(spark, sf), "k", "b", FEED_ORDER)


def _fold_rows(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return replay(feeds.customer_rows(spark, sf), feeds.customer_rows_feed(spark, sf), "k", "b", FEED_ORDER, mode=mode)


def replay_fold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The replay of whole customer rows, all columns."""
    return _fold_rows(spark, sf, REFERENCE)


def replay_latest_wins(spark: SparkSession, sf: str) -> DataFrame:
    return _fold_rows(spark, sf, LATEST_WINS)


def _history(spark: SparkSession, sf: str, weekly: bool = True) -> DataFrame:
    """The row changes of all batches of the customers' feed."""
    feed = feeds.customer_rows_feed(spark, sf)
    feed = feeds.weekly(feed) if weekly else feed
    return paths.stage(history(feeds.customer_rows(spark, sf), feed, "k", "b", FEED_ORDER))


def replay_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The customers after the row changes of thirty daily batches."""
    return apply_changes(feeds.customer_rows(spark, sf), _history(spark, sf, weekly=False), "k")


def replay_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """The thirty batches landed as files, found at once by a single stream run, applied as if one by one."""
    root = paths.new_scratch(spark)
    feed = feeds.customer_rows_feed(spark, sf)
    table = PartitionedTable(spark, f"{root}/bronze", "k", PARTITIONS)
    ingest = BronzeIngest(table, feed.schema, FEED_ORDER, batch="b")
    ingest.bootstrap(feeds.customer_rows(spark, sf))
    feed.write.parquet(f"{root}/cdc")
    ingest.run(f"{root}/cdc")
    return table.read()


def changes_by_version(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).where(F.col("_commit_version").between(2, 4))


def table_at_version(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(feeds.customer_rows(spark, sf), _history(spark, sf).where("_commit_version <= 3"), "k")


def latest_row_change_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return latest_row_changes(_history(spark, sf), "k")


def _guarded_feed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Each user's newest event of the first third of the month is stored; all events come in batches that hold events of any
    age, most of them older than what is stored by then."""
    events = load(spark, sf, "events").withColumnRenamed("user_id", "k")
    stored = latest(events.where(F.dayofmonth("ts") <= 10), "k", FEED_ORDER)
    kind = F.col("event_type")
    operation = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE")
    turn = F.when(F.dayofmonth("ts") % 3 == 0, 1).otherwise(F.col("event_id") % 4 + 2)
    return stored, events.withColumn("_operation", operation).withColumn("b", turn.cast("int"))


def replay_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of changes older than what they meet, which are ignored; a deleted row has no memory."""
    stored, feed = _guarded_feed(spark, sf)
    return fold_guarded(stored, feed, "k", "b", FEED_ORDER, "ts")


def replay_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a stream run into a table that remembers deleted keys, so that late changes don't bring them back."""
    root = paths.new_scratch(spark)
    stored, feed = _guarded_feed(spark, sf)
    table = PartitionedTable(spark, f"{root}/events", "k", PARTITIONS)
    ingest = BronzeIngest(table, feed.schema, FEED_ORDER, batch="b", guard="ts", keep_deleted="true")
    ingest.bootstrap(stored)
    feed.write.parquet(f"{root}/cdc")
    ingest.run(f"{root}/cdc")
    return table.read()


def _order_batches(spark: SparkSession, sf: str) -> PartitionedTable:
    """The orders before 1998, and two batches by priority: later orders come, and some of the early ones change or go."""
    orders = load(spark, sf, "orders")
    table = PartitionedTable(spark, f"{paths.new_scratch(spark)}/orders", "o_orderkey", PARTITIONS)
    early = F.year("o_orderdate") < 1998
    table.overwrite(orders.where(early))
    operation = (
        F.when(~early, "INSERT").when(F.col("o_orderstatus") == "P", "DELETE").when(F.col("o_orderkey") % 40 == 1, "UPDATE")
    )
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("_operation", operation)
    urgent = F.col("o_orderpriority") < "3"
    table.merge(1, changed.where(urgent))
    table.merge(2, changed.where(urgent & F.lit(False)))  # a batch without rows, which leaves nothing
    table.merge(3, changed.where(~urgent))
    return table


def partitioned_orders(spark: SparkSession, sf: str) -> DataFrame:
    return _order_batches(spark, sf).read()


def partitioned_order_changes(spark: SparkSession, sf: str) -> DataFrame:
    return _order_batches(spark, sf).read_changes(1).drop("_commit_timestamp")


def table_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    """Orders stored as a keyed table, then read through SQL by name."""
    table = KeyedTable(spark, f"{paths.new_scratch(spark)}/orders", "o_orderkey")
    table.overwrite(load(spark, sf, "orders"))
    table.register("bronze_orders")
    return spark.sql("SELECT * FROM bronze_orders")


def _silver(spark: SparkSession, sf: str) -> tuple[DataFrame, list, Column]:
    """A filtered projection of the customers with a renamed key: its rows before all changes, columns, filter."""
    columns = [F.col("k").alias("id"), F.col("c_acctbal").alias("balance"), "c_name", "c_nationkey", "c_mktsegment"]
    where = F.col("c_acctbal") > 20
    return feeds.customer_rows(spark, sf).where(where).select(*columns), columns, where


def silver_from_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The projection's own row changes over all versions, derived from those of the customers."""
    before, columns, where = _silver(spark, sf)
    changes = paths.stage(derived_changes(_history(spark, sf), "k", columns, where))
    return apply_changes(before, changes, "id", one_commit=True)


def silver_merged_from_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The customers' row changes merged into the projection, version by version."""
    before, columns, where = _silver(spark, sf)
    feed = projected_operations(_history(spark, sf), columns, where, ["_commit_version"])
    return replay(before, feed, "id", "_commit_version", "_commit_version")


def silver_merged_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """All versions in one batch: the latest row change of a key alone is merged, and an INSERT leaves a row that is there."""
    before, columns, where = _silver(spark, sf)
    return merge(before, paths.stage(latest_operations(_history(spark, sf), "k", columns, where)), "id")


SILVER_SQL = "SELECT k AS id, c_acctbal AS balance, c_name, c_nationkey, c_mktsegment FROM {source} WHERE c_acctbal > 20"


def silver_from_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The projection given as SQL text, kept by stream runs."""
    root = paths.new_scratch(spark)
    feed = feeds.weekly(feeds.customer_rows_feed(spark, sf))
    bronze = BronzeIngest(PartitionedTable(spark, f"{root}/bronze", "k", PARTITIONS), feed.schema, FEED_ORDER, batch="b")
    bronze.bootstrap(feeds.customer_rows(spark, sf))
    silver = SilverIngest(PartitionedTable(spark, f"{root}/silver", "id", PARTITIONS), bronze.table, SILVER_SQL)
    silver.bootstrap()
    feed.write.parquet(f"{root}/cdc")
    bronze.run(f"{root}/cdc")
    silver.run()
    return silver.table.read()


# -- distinct ---------------------------------------------------------------------------------


def distinct_products(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_values(load(spark, sf, "lineitem"), "l_partkey").orderBy("l_partkey")


def _line_history(spark: SparkSession, sf: str, each_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """The lines at the end of the snapshot year and the row changes of each year after it, from version 1."""
    before, feed = feeds.split_lines(spark, sf, each_line)
    before = paths.stage(before)
    numbered = feed.withColumn("b", F.col("b") - feeds.SNAPSHOT_YEAR)
    return before, paths.stage(history(before, numbered, "k", "b", LINE_ORDER))


def _kept(spark: SparkSession, sf: str, columns: list[str], each_line: bool) -> DataFrame:
    before, changes = _line_history(spark, sf, each_line)
    counts = paths.stage(value_counts(before, columns))
    changes = count_row_changes(counts, paths.stage(value_deltas(changes, columns)), columns)
    return apply_changes(counts, paths.stage(changes), columns, one_commit=True).select(*columns)


def distinct_products_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """The products, kept by adding up row changes; one line an order."""
    return _kept(spark, sf, ["p"], False)


def distinct_products_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Products that entered or left the set, per version."""
    before, changes = _line_history(spark, sf)
    return set_history(before, changes, "p")


def distinct_line_products_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """The products of all lines that are left, not of one line an order."""
    return _kept(spark, sf, ["p"], True)


def distinct_line_products_changes(spark: SparkSession, sf: str) -> DataFrame:
    before, changes = _line_history(spark, sf, each_line=True)
    return set_history(before, changes, "p")


def distinct_offers_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of product and supplier that a line holds: a set over two columns, whose members come and go."""
    return _kept(spark, sf, ["p", "s"], True)


def distinct_offers_changes(spark: SparkSession, sf: str) -> DataFrame:
    before, changes = _line_history(spark, sf, each_line=True)
    return set_history(before, changes, ["p", "s"])


def distinct_offers_streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The same set, kept by stream runs: the lines' table from all landed years, the pairs from its row changes."""
    root = paths.new_scratch(spark)
    before, feed = feeds.split_lines(spark, sf, each_line=True)
    bronze = BronzeIngest(PartitionedTable(spark, f"{root}/lines", "k", PARTITIONS), feed.schema, LINE_ORDER, batch="b")
    bronze.bootstrap(before)
    offers = DistinctIngest(PartitionedTable(spark, f"{root}/offers", ["p", "s"], PARTITIONS), bronze.table)
    offers.bootstrap()
    feed.write.parquet(f"{root}/cdc")
    bronze.run(f"{root}/cdc")
    offers.run()
    return offers.read()


# -- the loyalty tables, from landing to the derived table --------------------------------------


def _loyalty(spark: SparkSession, sf: str, name: str, derived: str) -> DataFrame:
    """A full load and all change batches landed, then one run of the keyed table and one of the derived table."""
    root = paths.new_scratch(spark)
    raw = f"{root}/raw"
    snapshot, feed = getattr(feeds, name)(spark, sf), getattr(feeds, f"{name}_feed")(spark, sf)
    landed = files.land_snapshot(snapshot, f"{raw}/full_load/{name}", "0001-01-01T00:00:00")
    ingest, silver = loyalty.bronze(spark, root, name, PARTITIONS), loyalty.silver(spark, root, derived, PARTITIONS)
    ingest.bootstrap(landed)
    silver.bootstrap()
    year = F.col("b").cast("string")  # as %04d prints it, which is slow
    year = F.when(F.col("b").between(1000, 9999), year).otherwise(F.format_string("%04d", F.col("b")))
    files.land_changes(feed, f"{raw}/cdc/{name}", F.concat(year, F.lit("-12-31T00:00:00")))
    ingest.execute(f"{raw}/full_load/{name}", f"{raw}/cdc/{name}")
    silver.run()
    return silver.read() if derived == "produtos" else silver.table.read()


def loyalty_clientes(spark: SparkSession, sf: str) -> DataFrame:
    return _loyalty(spark, sf, "clientes", "clientes")


def loyalty_transacoes(spark: SparkSession, sf: str) -> DataFrame:
    return _loyalty(spark, sf, "transacoes", "transacoes")


def loyalty_transacao_produto(spark: SparkSession, sf: str) -> DataFrame:
    return _loyalty(spark, sf, "transacao_produto", "transacao_produto")


def loyalty_produtos(spark: SparkSession, sf: str) -> DataFrame:
    return _loyalty(spark, sf, "transacao_produto", "produtos")


QUERIES = {
    query.__name__: query
    for query in (
        silver_projection_clients,
        stamp_snapshot,
        conform_schema,
        scale_round_restore,
        date_parse_profile,
        csv_snapshot,
        latest_snapshot,
        drifting_types,
        drifting_stream,
        rejected_rows,
        accepted_rows,
        schema_document,
        latest_event_per_user,
        latest_line_per_key,
        next_pending_batch,
        emitted_rows,
        pending_rows,
        emitted_key_set,
        union_change_sets,
        keyed_sample,
        exact_sample,
        exact_sample_of_one,
        remembered_pending,
        extractions_in_turn,
        op_counts_by_day,
        layer_counts,
        profile_landings,
        reconciliation,
        merge_once,
        merge_once_rows,
        merge_once_latest_wins,
        merge_changes,
        merge_null_and_unknown_ops,
        merge_guarded,
        snapshot_diff,
        snapshot_diff_rows,
        snapshot_diff_digest,
        snapshot_diff_repeated_keys,
        replay_fold,
        replay_fold_rows,
        replay_latest_wins,
        replay_daily,
        replay_backlog,
        replay_guarded,
        replay_tombstones,
        partitioned_orders,
        partitioned_order_changes,
        changes_by_version,
        table_at_version,
        latest_row_change_per_key,
        table_bootstrap,
        silver_from_changes,
        silver_merged_from_changes,
        silver_merged_backlog,
        silver_from_sql,
        distinct_products,
        distinct_products_maintained,
        distinct_products_changes,
        distinct_line_products_maintained,
        distinct_line_products_changes,
        distinct_offers_maintained,
        distinct_offers_changes,
        distinct_offers_streamed,
        loyalty_clientes,
        loyalty_transacoes,
        loyalty_transacao_produto,
        loyalty_produtos,
    )
}
