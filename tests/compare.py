"""Run a query in Spark and its SQL in DuckDB and report every difference."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

from spendlens.plans.bindings import RAW


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kind(text: str) -> str:
    """One name per type family in both engines."""
    text = text.lower()
    same = {
        "bigint": "bigint", "int": "int", "integer": "int", "string": "text", "varchar": "text", "double": "double",
        "boolean": "boolean", "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
    }
    return same.get(text, text)


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


def key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) for v in row)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, exact: bool = True) -> list[str]:
    names = sorted(df.columns)
    out = []
    rel = con.sql(sql)
    other = sorted(rel.columns)
    if names != other:
        return [f"columns: only Spark {set(names) - set(other)}, only SQL {set(other) - set(names)}"]
    types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    for name, dtype in zip(rel.columns, rel.types):
        if types[name] != kind(str(dtype)):
            out.append(f"type of {name}: {types[name]} / {dtype}")
    left = sorted((tuple(normal(v) for v in r) for r in df.select(*names).collect()), key=key)
    right = sorted(
        (tuple(normal(v) for v in r) for r in rel.project(", ".join(f'"{n}"' for n in names)).fetchall()), key=key
    )
    if len(left) != len(right):
        out.append(f"rows: {len(left)} / {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        out.append(f"{len(bad)} rows differ, first: {cells[:4]}")
    return out
