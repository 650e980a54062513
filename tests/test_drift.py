"""Files that disagree on types, values without an equal, and rows that are rejected."""

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.schemas import REJECT, TO_NULL, conform, losses, lossy, split
from changeflow.sources import files
from changeflow.sources.partitioned import PartitionedTable
from changeflow.streaming.ingest import BronzeIngest
from tests.test_merge import bag

LOST = [
    (1.239, "double", "decimal(10,2)"), ("1.239", "string", "decimal(10,2)"), (9007199254740993, "bigint", "double"),
    ("9007199254740993", "string", "double"), (16777217, "int", "float"), ("16777217", "string", "float"), (2.5, "double", "bigint"),
    (1e30, "double", "bigint"), ("1.5", "string", "int"), ("x", "string", "double"), ("2024-01-01 05:00:00", "string", "date"),
    (datetime(2024, 1, 1, 5), "timestamp_ntz", "date"), (Decimal("1.25"), "decimal(10,2)", "decimal(10,1)"), (300, "int", "tinyint"),
    (0.1, "double", "float"), ((1 << 63) - 1, "bigint", "double"), ("soon", "string", "date"), (Decimal("0.5"), "decimal(3,1)", "int"),
]
HELD = [
    (1.25, "double", "decimal(10,2)"), ("1.2", "string", "decimal(10,2)"), (9007199254740992, "bigint", "double"), ("0.1", "string", "double"),
    ("0.1", "string", "float"), (2.0, "double", "bigint"), ("7", "string", "int"), ("2024-01-01", "string", "date"), (float("nan"), "double", "float"),
    (datetime(2024, 1, 1), "timestamp_ntz", "date"), (Decimal("1.50"), "decimal(10,2)", "decimal(10,1)"), (1.239, "double", "string"),
    (date(2024, 1, 1), "date", "timestamp_ntz"), (None, "string", "int"), (5, "int", "double"), ("1e3", "string", "double"),
]


def test_values_without_an_equal(spark):
    every = LOST + HELD
    row = spark.createDataFrame([tuple(v for v, _, _ in every)], ", ".join(f"c{n} {s}" for n, (_, s, _) in enumerate(every)))
    schema = StructType.fromDDL(", ".join(f"c{n} {t}" for n, (_, _, t) in enumerate(every)))
    found = row.select(*[lossy(F.col(f.name), f.dataType, schema[f.name].dataType).alias(f.name) for f in row.schema.fields]).first()
    assert [(x, found[n]) for n, x in enumerate(every)] == [(x, x in LOST) for x in every]
    counts = losses(row, schema).first().asDict()
    assert {n for n, c in counts.items() if c} == {f"c{n}" for n in range(len(LOST))}
    good, bad = split(row, schema)
    assert good.count() == 0 and bad.count() == len(LOST)
    assert conform(row, schema, TO_NULL).count() == 1
    held = row.select(*[f"c{n}" for n in range(len(LOST), len(every))])
    assert conform(held, StructType(schema.fields[len(LOST):])).count() == 1
    for n in (0, 2, 10):
        with pytest.raises(Exception, match=f"c{n} can't be"):
            conform(row.select(f"c{n}"), StructType([schema.fields[n]])).collect()


def test_split_names_columns_and_reasons(spark):
    rows = spark.createDataFrame([("1", 2.0, "a"), ("x", 2.5, "b"), ("3", None, None)], "Id string, n double, other string")
    good, bad = split(rows, StructType.fromDDL("id int, n bigint, more string"))
    assert bag(good.collect()) == bag([(1, 2, None), (3, None, None)])
    found = [(r._column, r._reason, json.loads(r._row)) for r in bad.orderBy("_column").collect()]
    assert found == [("id", "not a int: x", {"Id": "x", "n": 2.5, "other": "b"}), ("n", "not a bigint: 2.5", {"Id": "x", "n": 2.5, "other": "b"})]


SCHEMA = "k bigint, v bigint, o bigint, _operation string"


def landed(spark, root, *batches):
    for n, (rows, schema) in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/cdc/b={n}")
    return f"{root}/cdc"


def table(spark, root, on_loss, **options):
    t = PartitionedTable(spark, f"{root}/t", "k", partitions=3)
    ingest = BronzeIngest(t, StructType.fromDDL(SCHEMA), "o", on_loss=on_loss, **options)
    spark.createDataFrame([(1, 10, 0), (2, 20, 0)], "k bigint, v int, o bigint").write.parquet(f"{root}/full")
    ingest.bootstrap(f"{root}/full")
    return ingest


DRIFTING = [
    ([(1, 11, 1, "UPDATE")], "k bigint, v bigint, o bigint, _operation string"),
    ([(3, 30.0, 2, "INSERT"), (4, 4.0, 2, "INSERT")], "k bigint, v double, o int, _operation string"),
    ([("2", "21", 3, "UPDATE"), ("5", "50", 3, "INSERT")], "K string, v string, o bigint, _operation string"),
    ([(6, 3, "INSERT")], "k int, o bigint, _operation string"),
]
EXPECTED = [(1, 11), (2, 21), (3, 30), (4, 4), (5, 50), (6, None)]


@pytest.mark.parametrize("on_loss", ["raise", "null", "reject"])
def test_a_stream_over_drifting_files(spark, root, on_loss):
    ingest = table(spark, root, on_loss)
    path = landed(spark, root, *DRIFTING)
    ingest.run(path)
    assert bag(ingest.table.read().select("k", "v").collect()) == bag(EXPECTED)
    ingest.run(path)
    assert ingest.table.version() == 1 and ingest.read_rejected().count() == 0


def test_files_in_turn(spark, root):
    ingest = table(spark, root, "raise")
    ingest.run(landed(spark, root, *DRIFTING), files_per_trigger=1)
    assert bag(ingest.table.read().select("k", "v").collect()) == bag(EXPECTED) and ingest.table.version() == 4


def test_rejected_rows_are_kept_and_the_good_ones_arrive(spark, root):
    ingest = table(spark, root, REJECT)
    path = landed(spark, root, *DRIFTING, ([(1, 1.5, 9, "UPDATE"), (7, 70.0, 9, "INSERT")], "k bigint, v double, o bigint, _operation string"))
    ingest.run(path)
    assert bag(ingest.table.read().select("k", "v").collect()) == bag([*EXPECTED, (7, 70)])
    bad = ingest.read_rejected().collect()
    assert [(r._column, r._reason, r._commit_version) for r in bad] == [("v", "not a bigint: 1.5", 1)]
    assert json.loads(bad[0]._row)["k"] == 1


def test_a_lossy_value_ends_the_batch(spark, root):
    ingest = table(spark, root, "raise")
    path = landed(spark, root, ([(1, 1.5, 9, "UPDATE")], "k bigint, v double, o bigint, _operation string"))
    with pytest.raises(Exception, match="v can't be bigint: 1.5"):
        ingest.run(path)
    assert ingest.table.version() == 0


def test_malformed_text_is_rejected(spark, root):
    ingest = BronzeIngest(PartitionedTable(spark, f"{root}/t", "k", 3), StructType.fromDDL(SCHEMA), "o", on_loss=REJECT, file_format="json")
    ingest.bootstrap(spark.createDataFrame([(1, 10, 0, None), (2, 20, 0, None)], SCHEMA))
    lines = ['{"k": 3, "v": 1, "o": 1, "_operation": "INSERT"}', '{"k": 4, "v": "oops', '{"k": 5, "v": 2, "o": 1, "_operation": "INSERT"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/json")
    ingest.run(f"{root}/json")
    assert bag(ingest.table.read().select("k", "v").collect()) == bag([(1, 10), (2, 20), (3, 1), (5, 2)])
    assert [(r._column, "oops" in r._reason) for r in ingest.read_rejected().collect()] == [(None, True)]


def test_groups_of_files_that_agree(spark, root):
    path = landed(spark, root, *DRIFTING)
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files.alike(spark, sorted(names))) == 4
    same = landed(spark, f"{root}/same", *[DRIFTING[0]] * 3)
    assert len(files.alike(spark, [same])) == 1
