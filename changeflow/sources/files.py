"""Snapshot and change files: typed reads and landing."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from changeflow.functions.schemas import MALFORMED, RAISE, conform, split
from changeflow.sources import paths

FULL_LOAD, CDC = "fullload", "cdc"


def read_delimited(
    spark: SparkSession, path: str, schema: StructType, sep: str = ";", multi_line: bool = False
) -> DataFrame:
    """Delimited text with a header row, its columns matched to a declared schema by name, without regard to case.

    Columns that the schema doesn't declare are left out. A declared column that the header lacks, files whose headers
    differ, and rows that don't fit raise an error. With ``multi_line`` quoted values may hold line breaks; a file is
    then read by one task.
    """
    options = {"sep": sep, "header": True, "multiLine": multi_line, "mode": "FAILFAST"}
    header = spark.read.csv(path, **options).columns
    declared = {f.name.lower(): f for f in schema.fields}
    missing = set(declared) - {name.lower() for name in header}
    if missing:
        raise ValueError(f"{path}: the header {header} lacks {sorted(missing)}")
    found = StructType([
        StructField(name, declared[name.lower()].dataType if name.lower() in declared else StringType()) for name in header
    ])
    rows = spark.read.schema(found).csv(path, enforceSchema=False, **options)
    names = {name.lower(): name for name in header}
    return rows.select(*[F.col(f"`{names[f.name.lower()]}`").alias(f.name) for f in schema.fields])


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", **options: str
) -> DataFrame:
    """Typed snapshot in any format that Spark reads; columns that parquet or JSON files lack are NULL. Delimited text goes
    through ``read_delimited``, which matches columns by name."""
    if file_format == "csv":
        return read_delimited(spark, path, schema, **options)
    return spark.read.format(file_format).schema(schema).options(**options).load(path)


def alike(spark: SparkSession, found: list[str], **options: str) -> list[DataFrame]:
    """Parquet files, each group of which agrees on the types of its columns, read as they are.

    Spark compares the footers of a group in parallel; a group that disagrees is halved. Files that follow each other in
    order mostly agree, so a change of type costs a few such jobs, not one per file.
    """
    try:
        whole = spark.read.option("mergeSchema", "true").options(**options).parquet(*found)
        whole.schema  # noqa: B018 - the footers are read here
        return [whole]
    except (PySparkException, Py4JJavaError) as e:
        # The types differ, or the names in case only.
        if len(found) == 1 or not re.search("CANNOT_MERGE|COLUMN_ALREADY_EXISTS", str(e)):
            raise
    half = len(found) // 2
    return alike(spark, found[:half], **options) + alike(spark, found[half:], **options)


def read_drifting(
    spark: SparkSession, found: list[str], schema: StructType, on_loss: str = RAISE, **options: str
) -> DataFrame:
    """Parquet whose column types differ between files or landings: each group is read as it is, then cast."""
    groups = [conform(part, schema, on_loss) for part in alike(spark, sorted(found), **options)]
    return reduce(DataFrame.unionByName, groups)


def split_drifting(spark: SparkSession, found: list[str], schema: StructType, **options: str) -> tuple[DataFrame, DataFrame]:
    """The same, with the rows that have no equal under the schema apart (see ``schemas.split``)."""
    parts = [split(part, schema) for part in alike(spark, sorted(found), **options)]
    good, bad = zip(*parts)
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def stream_names(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The names of parquet change files as a stream, every new file once; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    reader = reader.option("maxFileAge", "36500d").option("pathGlobFilter", "*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("path")


def stream_changes(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files_per_trigger: int | None = None,
    file_format: str = "parquet",
    malformed: bool = False,
    **options: str,
) -> DataFrame:
    """Change files as a stream: every new file once, whatever its time. Malformed text is an error, or with ``malformed``
    stands in a column of that name; the headers of delimited files must have the declared columns in their order.

    Spark's file source passes over files that are older, by ``maxFileAge``, than the newest it has seen, by default a
    week; here the limit is a century, so that files landed late are read.
    """
    defaults = {"maxFileAge": "36500d", "mode": "FAILFAST"}
    if file_format == "csv":
        defaults |= {"header": "true", "enforceSchema": "false"}
    if malformed:
        schema = StructType([*schema.fields, StructField(MALFORMED, StringType())])
        defaults |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    reader = spark.readStream.format(file_format).schema(schema).options(**defaults | options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stamp(df: DataFrame, extracted_at: str | Column, load_type: str) -> DataFrame:
    """Add the extraction metadata: ISO time text, one for all rows or a column, and kind of load."""
    return df.withColumn("_extracted_at", F.lit(extracted_at)).withColumn("_load_type", F.lit(load_type))


def _landing_name(extracted_at: str) -> str:
    """2024-01-02T05:04:05.5+02:00 -> 20240102_030405_500000; times without an offset are UTC."""
    time = datetime.fromisoformat(extracted_at)
    if time.tzinfo is not None:
        time = time.astimezone(timezone.utc)
    return time.strftime("%Y%m%d_%H%M%S_%f")


def land_snapshot(df: DataFrame, path: str, extracted_at: str) -> str:
    """Write a stamped full load to a directory of its own; its ``_SUCCESS`` file completes it.

    A complete load of the same microsecond is never replaced: landing another one raises an error. What a landing that
    died has left is replaced.
    """
    target = f"{path}/snapshot_id={_landing_name(extracted_at)}"
    if paths.exists(df.sparkSession, f"{target}/_SUCCESS"):
        raise FileExistsError(f"{target} is complete already")
    paths.delete(df.sparkSession, target)
    stamp(df, extracted_at, FULL_LOAD).write.parquet(target)
    return target


def newest_snapshot(spark: SparkSession, path: str) -> str:
    """Directory of the newest complete full load, found from the listing without reading data."""
    for name in sorted(paths.partition_values(spark, path, "snapshot_id"), reverse=True):
        candidate = f"{path}/snapshot_id={name}"
        if paths.exists(spark, f"{candidate}/_SUCCESS"):
            return candidate
    raise FileNotFoundError(f"no complete snapshot under {path}")


def land_changes(df: DataFrame, path: str, extracted_at: str | Column) -> None:
    """Append a stamped change batch, or several told apart by their times, to the directory the change stream reads."""
    stamp(df, extracted_at, CDC).write.mode("append").parquet(path)
