"""Registered queries against DuckDB on the same files."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float) and v == 0 and not math.isnan(v):
        return 0.0
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def same_rows(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows and columns, otherwise what differs."""
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = _sorted_rows(names, cur.fetchall())
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None
