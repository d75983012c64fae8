"""Compare registered queries with their SQL in DuckDB: names, row counts and values."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql):
    cursor = db.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, db, sql) -> str | None:
    """None when both results agree, else a short account of how they differ."""
    left, right = spark_rows(df), sql_rows(db, sql)
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        return f"{len(wrong)} rows differ, first {wrong[0]}"
    return None if left[1] else "both empty"
