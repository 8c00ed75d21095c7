"""Runs a checked query and its SQL and compares names, types and rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark's name of a type next to the other engine's.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value: object) -> object:
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def compare(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Number of rows; raises where the two results differ."""
    cursor = connection.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    ours = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields}
    assert sorted(ours) == sorted(theirs), f"columns {sorted(ours)} <> {sorted(theirs)}"
    assert ours == theirs, f"types {ours} <> {theirs}"
    names = list(theirs)
    expected = Counter(tuple(map(_cell, row)) for row in cursor.fetchall())
    found = Counter(tuple(_cell(row[n]) for n in names) for row in df.collect())
    missing, extra = expected - found, found - expected
    assert not missing and not extra, (
        f"{missing.total()} rows missing, {extra.total()} too many: "
        f"{str(list(missing)[:2])[:1500]} / {str(list(extra)[:2])[:1500]}"
    )
    return found.total()
