"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _value(v: object) -> object:
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_value(x) for x in v)
    return v


def _bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_value(r[i])) for i in order) for r in rows)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _bag(df.columns, got), _bag(names, want)
    if a == b:
        return None
    more, fewer = a - b, b - a
    return (
        f"{len(got)} rows vs {len(want)}; {sum(more.values())} differ; columns {sorted(names)}; "
        f"spark {list(more)[:2]} sql {list(fewer)[:2]}"
    )
