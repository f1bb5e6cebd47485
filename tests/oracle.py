"""Comparison of a query with its SQL: same columns and types, same rows in any order."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type name -> DuckDB type name
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def order(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def difference(df, con, sql: str) -> str:
    """Empty text if equal, else what differs first."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c[0]: str(c[1]) for c in found.description}
    typed = con.execute(f"DESCRIBE {sql}").fetchall()
    kinds = {t[0]: t[1] for t in typed}
    for name, kind in df.dtypes:
        if TYPES.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    found = con.execute(sql)
    at = [names.index(c) for c in sorted(names)]
    want = sorted(([cell(r[i]) for i in at] for r in found.fetchall()), key=order)
    got = sorted(([cell(r[c]) for c in sorted(names)] for r in df.collect()), key=order)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return ""
