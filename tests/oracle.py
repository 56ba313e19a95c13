"""Comparison of Spark results with DuckDB results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(_normal(r[c]) for c in columns) for r in df.collect()), key=_key)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(_normal(row[i]) for i in order) for row in cursor.fetchall()]
    return sorted(names), sorted(rows, key=_key)


def differences(df, con, sql) -> str | None:
    """None if names, types and values agree, else what differs first."""
    columns, mine = spark_rows(df)
    names, theirs = duck_rows(con, sql)
    if columns != names:
        return f"columns {columns} != {names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}; first {mine[:2]} / {theirs[:2]}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{columns}: {a} != {b}"
    return None
