"""Compare a query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, connection, sql) -> str | None:
    """None if equal, else what differs."""
    result = connection.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    have_columns, have = rows_of(df.columns, df.collect())
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    if len(have) != len(want):
        return f"{len(have)} rows, expected {len(want)}"
    for h, w in zip(have, want):
        if h != w:
            return f"row {h} != {w}"
    return None
