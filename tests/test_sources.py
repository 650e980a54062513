"""Files, schemas, extraction, expressions and profiles."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.functions.columns import as_timestamp, file_stamp, in_sample, iso_text, scale_and_round
from changeflow.functions.schemas import conform, load_schema, losses
from changeflow.operators import checks, pending
from changeflow.operators.diff import snapshot_diff
from changeflow.operators.distinct import distinct_values
from changeflow.sources import files, paths
from tests.test_merge import bag


def test_schema_document(spark, tmp_path):
    document = {"type": "struct", "fields": [
        {"metadata": {}, "name": "id", "nullable": True, "type": "string"},
        {"metadata": {}, "name": "n", "nullable": True, "type": "long"}]}
    (tmp_path / "t.json").write_text(json.dumps(document, indent=2))
    assert load_schema(spark, str(tmp_path / "t.json")) == StructType().add("id", "string").add("n", "long")


def test_conform(spark):
    df = spark.createDataFrame([(1, 2.0, "7", "x"), (2, None, "bad", "y")], "ID int, n double, s string, extra string")
    got = conform(df, StructType.fromDDL("id string, n bigint, s bigint, missing string"), on_loss="null")
    assert got.columns == ["id", "n", "s", "missing"]
    assert bag(got.collect()) == bag([("1", 2, 7, None), ("2", None, None, None)])


def test_values_that_do_not_fit_are_refused_and_counted(spark):
    df = spark.createDataFrame([(1.0, "7"), (1.5, "bad"), (None, None), (1e30, "8")], "n double, s string")
    schema = StructType.fromDDL("n bigint, s int")
    assert tuple(losses(df, schema).first()) == (2, 1)
    assert bag(conform(df.where("n = 1"), schema).collect()) == bag([(1, 7)])
    for bad in ("n = 1.5", "n = 1e30", "s = 'bad'"):
        with pytest.raises(Exception, match="can't be"):
            conform(df.where(bad), schema).collect()
    twice = spark.createDataFrame([(1,)], "id int").select("id", F.col("id").alias("i2")).toDF("id", "i2")
    with pytest.raises(ValueError, match="case only"):
        conform(twice.toDF("id", "ID"), schema)


def test_drifting_landings(spark, root):
    schema = StructType.fromDDL("id bigint, n bigint")
    spark.createDataFrame([(1, 5)], "id int, n int").write.parquet(f"{root}/a")
    spark.createDataFrame([(2, 6.0), (3, None)], "id bigint, n double").write.parquet(f"{root}/b")
    assert bag(files.read_drifting(spark, [f"{root}/a", f"{root}/b"], schema).collect()) == bag([(1, 5), (2, 6), (3, None)])


def test_delimited(spark, root):
    df = spark.createDataFrame([("a", 1), ("b", None)], "id string, n bigint")
    df.write.csv(f"{root}/csv", sep=";", header=True)
    assert bag(files.read_delimited(spark, f"{root}/csv", df.schema).collect()) == bag([("a", 1), ("b", None)])


def test_delimited_is_matched_by_name(spark, tmp_path):
    schema = StructType.fromDDL("a string, b int")
    (tmp_path / "one.csv").write_text('B;extra;a\n1;x;"p\nq"\n2;y;r\n')
    one = str(tmp_path / "one.csv")
    assert bag(files.read_delimited(spark, one, schema, multi_line=True).collect()) == bag([("p\nq", 1), ("r", 2)])
    with pytest.raises(Exception):
        files.read_delimited(spark, one, schema).collect()
    (tmp_path / "two.csv").write_text("b;a\nbad;x\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "two.csv"), schema).collect()
    (tmp_path / "three.csv").write_text("a;c\nx;1\n")
    with pytest.raises(ValueError, match="lacks"):
        files.read_delimited(spark, str(tmp_path / "three.csv"), schema)
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a;b\nx;1\n")
    (tmp_path / "d" / "2.csv").write_text("b;a\n2;y\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "d"), schema).collect()


def test_loads_never_replace_each_other(spark, root):
    df = spark.createDataFrame([(1,)], "id int")
    a = files.land_snapshot(df, root, "2024-01-01T10:00:00.1")
    b = files.land_snapshot(df, root, "2024-01-01T10:00:00.2")
    assert a != b and files.newest_snapshot(spark, root) == b
    with pytest.raises(FileExistsError):
        files.land_snapshot(df, root, "2024-01-01T10:00:00.2")
    # 09:00 at +09:00 is midnight in UTC, before 05:00 in UTC.
    late = files.land_snapshot(df, root, "2024-01-02T05:00:00+00:00")
    files.land_snapshot(df, root, "2024-01-02T09:00:00+09:00")
    assert files.newest_snapshot(spark, root) == late
    paths.delete(spark, f"{late}/_SUCCESS")
    assert files.land_snapshot(df, root, "2024-01-02T05:00:00+00:00") == late


def test_newest_complete_snapshot(spark, root):
    df = spark.createDataFrame([(1,)], "id int")
    first = files.land_snapshot(df, root, "2024-01-01T10:00:00")
    second = files.land_snapshot(df.withColumn("id", F.lit(2)), root, "2024-01-02T10:00:00.123456")
    assert second.endswith("snapshot_id=20240102_100000_123456")
    assert files.newest_snapshot(spark, root) == second
    # A landing without its marker is still being written.
    paths.delete(spark, f"{second}/_SUCCESS")
    assert files.newest_snapshot(spark, root) == first
    row = files.read_snapshot(spark, first, StructType.fromDDL("id int, _load_type string, _operation string")).first()
    assert tuple(row) == (1, "fullload", None)
    with pytest.raises(FileNotFoundError):
        files.newest_snapshot(spark, f"{root}/none")


def test_extraction_in_turns(spark):
    rows = spark.createDataFrame([(k, (k * 7) % 10) for k in range(10)], "id int, day int")
    emitted = spark.createDataFrame([], "_key string")
    seen = []
    for _ in range(4):
        batch = pending.next_batch(rows, emitted, "id", ["day", "id"], 3)
        seen.append([r.day for r in batch.collect()])
        emitted = pending.extend_key_set(emitted, batch, "id")
    assert seen == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9]]
    assert pending.pending_rows(rows, emitted, "id").count() == 0
    assert pending.emitted_rows(rows, emitted, "id").count() == 10


def test_key_memory(spark, root):
    rows = spark.createDataFrame([(k, k) for k in range(10)], "id int, day int")
    pending.remember(f"{root}/keys", rows.where("id < 4"), "id")
    pending.remember(f"{root}/keys", rows.where("id < 6"), "id")
    emitted = spark.read.parquet(f"{root}/keys")
    assert emitted.count() == 10
    assert [r.id for r in pending.next_batch(rows, emitted, "id", ["day"], 2).collect()] == [6, 7]
    assert pending.emitted_rows(rows, emitted, "id").count() == 6


def test_next_batch_puts_missing_dates_last(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 4)], "id int, day int")
    emitted = spark.createDataFrame([], "_key string")
    assert [r.id for r in pending.next_batch(rows, emitted, "id", ["day"], 3).collect()] == [3, 2, 1]


def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n"), (5, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (None, "n"), (5, "e")], "k int, v string")
    got = snapshot_diff(before, after, "k").collect()
    assert bag(got) == bag([(2, "x", "UPDATE"), (3, None, "DELETE"), (4, "d", "INSERT"), (5, "e", "UPDATE")])


def test_snapshot_diff_counts_repeated_rows(spark):
    before = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "c"), (None, "n"), (None, "m")], "k int, v string")
    after = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d"), (2, "d"), (None, "n"), (3, "e"), (3, "e")], "k int, v string")
    got = snapshot_diff(before, after, "k")
    assert bag(got.collect()) == bag([
        (1, "a", "DELETE"), (2, "c", "DELETE"), (2, "d", "INSERT"), (2, "d", "INSERT"), (None, "m", "DELETE"),
        (3, "e", "INSERT"), (3, "e", "INSERT"),
    ])
    assert snapshot_diff(after, after, "k").count() == 0
    assert "SortAggregate" not in got._jdf.queryExecution().toString()


def test_rounding_is_half_to_even_and_keeps_the_type(spark):
    df = spark.createDataFrame([(1, 1.0), (3, 3.0), (5, 5.0), (-1, None)], "n int, x double")
    got = df.select(scale_and_round("n", 0.5, "int").alias("n"), scale_and_round("x", 0.5, "double").alias("x"))
    assert got.dtypes == [("n", "int"), ("x", "double")]
    assert bag(got.collect()) == bag([(0, 0.5), (2, 1.5), (2, 2.5), (0, None)])


def test_time_text_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on this day in that zone.
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00.5' AS ts")
        assert tuple(df.select(file_stamp(F.col("ts")), iso_text(F.col("ts"))).first()) == (
            "20240310_023000", "2024-03-10T02:30:00.5")
        assert df.select((as_timestamp(F.lit("2024-03-10 02:30:00.5")) == F.col("ts"))).first()[0]
        assert df.select(as_timestamp(F.lit("no date"))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sample_is_stable_and_near_its_rate(spark):
    keys = spark.range(-50_000, 150_000)
    counts = {keys.repartition(n).where(in_sample(F.col("id"), 0.03)).count() for n in (1, 5)}
    assert len(counts) == 1 and abs(counts.pop() / 200_000 - 0.03) < 0.003
    big = spark.range(2**62, 2**62 + 10)
    assert big.where(in_sample(F.col("id"), 1.0)).count() == 10


def test_profile_and_counts(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "INSERT"), (2, "2024-02-01", "DELETE"), (3, None, None)],
                               "id int, day string, _operation string")
    got = {r.column: r for r in checks.profile_columns(df).collect()}
    assert got["id"].maybe_key and not got["day"].maybe_key
    assert got["day"].maybe_date and not got["_operation"].maybe_date
    assert tuple(checks.operation_counts(df).first()) == (3, 1, 0, 1)
    assert bag(checks.layer_counts({"a": df, "b": distinct_values(df, "day")}).collect()) == bag([("a", 3), ("b", 2)])
