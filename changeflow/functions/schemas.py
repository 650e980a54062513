"""Declared schemas and conformance of drifting files to them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    LongType,
    MapType,
    NumericType,
    StringType,
    StructType,
)


def load_schema(spark: SparkSession, path: str) -> StructType:
    """Read a schema document (the JSON form of a struct) from any file system Spark reaches."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return StructType.fromJson(json.loads(text))


RAISE, TO_NULL, REJECT = "raise", "null", "reject"
# Columns of rejected rows.
COLUMN, REASON, ROW = "_column", "_reason", "_row"
MALFORMED = "_malformed"
WIDE = "decimal(38,18)"


def lossy(column: Column, source: DataType, target: DataType) -> Column:
    """Whether a value has no equal in the target type: text that doesn't read as it, a number or time that would be cut or
    rounded. Values are cast and cast back; a number given as text is compared by its decimal digits."""
    cast = column.try_cast(target)
    lost = column.isNotNull() & cast.isNull()
    if isinstance(target, StringType) or isinstance(source, (ArrayType, MapType, StructType)):
        return lost
    if isinstance(source, LongType) and isinstance(target, (DoubleType, FloatType)):
        lost = lost | F.coalesce(cast >= float(1 << 63), F.lit(False))  # casting it back would stop at the greatest bigint
    if not isinstance(source, StringType):
        return lost | (column.isNotNull() & ~cast.try_cast(source).eqNullSafe(column))
    if isinstance(target, NumericType):
        return lost | F.coalesce(column.try_cast(WIDE) != cast.cast("string").try_cast(WIDE), F.lit(False))
    if isinstance(target, DateType):
        return lost | F.coalesce(column.try_cast("timestamp_ntz") != cast.cast("timestamp_ntz"), F.lit(False))
    return lost


def _present(df: DataFrame) -> dict[str, str]:
    present = {name.lower(): name for name in df.columns}
    if len(present) < len(df.columns):
        raise ValueError(f"columns that differ in case only: {df.columns}")
    return present


def losses(df: DataFrame, schema: StructType) -> DataFrame:
    """One row: per declared column of another type, how many values it can't hold."""
    present = _present(df)
    counts = [F.lit(0).cast("bigint").alias("none")]
    for field in schema.fields:
        source = present.get(field.name.lower())
        if source is not None and df.schema[source].dataType != field.dataType:
            lost = lossy(F.col(f"`{source}`"), df.schema[source].dataType, field.dataType)
            counts.append(F.count_if(lost).alias(field.name))
    return df.agg(*counts).drop("none")


def conform(df: DataFrame, schema: StructType, on_loss: str = RAISE) -> DataFrame:
    """Cast every column to the declared type; a missing column becomes a typed NULL.

    A value that the declared type can't hold raises an error that names its column; with ``on_loss="null"`` it becomes
    NULL (one that is only cut or rounded is kept so), and ``losses`` counts such values; ``split`` keeps such rows apart. Names match without regard
    to case, and two columns that differ in case only are refused. Columns the schema does not declare are dropped, as
    in a typed parquet read.
    """
    present = _present(df)
    columns = []
    for field in schema.fields:
        source = present.get(field.name.lower())
        if source is None:
            column = F.lit(None).cast(field.dataType)
        elif df.schema[source].dataType == field.dataType:
            column = F.col(f"`{source}`")
        else:
            value, kind = F.col(f"`{source}`"), df.schema[source].dataType
            column = value.try_cast(field.dataType)
            if on_loss == RAISE:
                message = F.concat(F.lit(f"{source} can't be {field.dataType.simpleString()}: "), value.cast("string"))
                column = F.when(lossy(value, kind, field.dataType), F.raise_error(message)).otherwise(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def split(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The conformed rows whose values all fit, and the others: one row for each value that doesn't, with the column's name,
    the reason and the whole source row as JSON. Text that a reader marked in the column ``_malformed`` is such a row, too.
    """
    present = _present(df)
    faults = []
    if MALFORMED in df.columns:
        text = F.col(MALFORMED)
        malformed = F.struct(F.lit(None).cast("string").alias(COLUMN), F.concat(F.lit("malformed: "), text).alias(REASON))
        faults.append(F.when(text.isNotNull(), malformed))
    for field in schema.fields:
        source = present.get(field.name.lower())
        if source is None or df.schema[source].dataType == field.dataType:
            continue
        value = F.col(f"`{source}`")
        reason = F.concat(F.lit(f"not a {field.dataType.simpleString()}: "), value.cast("string"))
        fault = F.struct(F.lit(field.name).alias(COLUMN), reason.alias(REASON))
        faults.append(F.when(lossy(value, df.schema[source].dataType, field.dataType), fault))
    found = F.filter(F.array(*faults), lambda x: x.isNotNull()) if faults else F.lit(None)
    if not faults:
        none = df.sparkSession.createDataFrame([], f"{COLUMN} string, {REASON} string, {ROW} string")
        return conform(df, schema), none
    good = conform(df.where(F.size(found) == 0).drop(MALFORMED), schema, on_loss=TO_NULL)
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != MALFORMED]), {"ignoreNullFields": "false"})
    bad = df.where(F.size(found) > 0).select(whole.alias(ROW), F.explode(found).alias("fault"))
    return good, bad.select(f"fault.{COLUMN}", f"fault.{REASON}", ROW)
