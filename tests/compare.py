"""Run a registered query in Spark and its SQL in DuckDB and compare the rows."""

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def differences(left, right, limit=5):
    """Human-readable differences between two (columns, rows) pairs."""
    if left[0] != right[0]:
        return [f"columns {left[0]} != {right[0]}"]
    if len(left[1]) != len(right[1]):
        only = set(left[1]) ^ set(right[1])
        return [f"{len(left[1])} rows != {len(right[1])} rows, e.g. {sorted(only, key=repr)[:4]}"]
    return [f"{a} != {b}" for a, b in zip(left[1], right[1]) if a != b][:limit]
