"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if glob.glob(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ", timespec="microseconds")
    return str(value)


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), _normal(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _normal(columns, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    columns, rows = spark_rows(df)
    other_columns, other_rows = duckdb_rows(con, sql)
    if columns != other_columns:
        return f"columns {columns} != {other_columns}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows != {len(other_rows)}"
    wrong = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
