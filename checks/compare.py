"""Run a query and its SQL side by side and compare rows, schema and values."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-memory database with the given tables as views."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if nothing does."""
    result = con.sql(sql)
    ours = dict(df.dtypes)
    theirs = dict(zip(result.columns, map(str, result.types)))
    if set(ours) != set(theirs):
        return [f"columns {sorted(set(ours) ^ set(theirs))}"]
    found = [
        f"type of {c}: {t} and {theirs[c]}" for c, t in ours.items() if _TYPES.get(t) != theirs[c]
    ]
    names = sorted(ours)
    order = [result.columns.index(n) for n in names]
    mine = sorted((tuple(map(_text, r)) for r in df.select(*names).collect()))
    other = sorted(tuple(_text(r[i]) for i in order) for r in result.fetchall())
    if len(mine) != len(other):
        found.append(f"rows: {len(mine)} and {len(other)}")
    elif mine != other:
        wrong = [(a, b) for a, b in zip(mine, other) if a != b]
        cells = [(n, x, y) for n, x, y in zip(names, *wrong[0]) if x != y]
        found.append(f"{len(wrong)} rows differ, first {cells}")
    return found


def _text(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)
