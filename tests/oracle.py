"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty if nothing does."""
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    names = sorted(described)
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} and {names}"]
    found = [
        f"type of {name}: {kind} and {described[name]}"
        for name, kind in df.dtypes
        if KINDS.get(kind) != described[name]
    ]
    order = [list(described).index(name) for name in names]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    actual = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if actual != expected:
        found.append(f"{sum(actual.values())} and {sum(expected.values())} rows")
        found += [f"only in Spark: {r}"[:400] for r in list((actual - expected))[:2]]
        found += [f"only in SQL: {r}"[:400] for r in list((expected - actual))[:2]]
    return found
