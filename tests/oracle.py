"""Compare a query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

from shelf_queries.inputs import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return value + 0.0
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_rows = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows vs {len(want_rows)}"
    got, want = normal(df.columns, got_rows), normal(names, want_rows)
    for g, w in zip(got, want):
        if g != w:
            return f"{g} vs {w}"
    return None
