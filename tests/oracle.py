"""Compare a query with its SQL on the same parquet files."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    """Columns in name order and rows as sorted text, so that both engines compare alike."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def oracle_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
