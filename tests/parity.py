"""Strict comparison of a Spark result with the SQL oracle: names, types, row count and every value."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

# Spark type names beside the names DuckDB gives the same types.
_TYPE_NAMES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(result, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    expected_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    actual_types = {
        n: _TYPE_NAMES.get(t, t.upper().replace(" ", "")) for n, t in result.dtypes
    }
    expected_types = {n: t.replace(" ", "") for n, t in expected_types.items()}
    found = [
        f"{n}: {actual_types.get(n)} instead of {expected_types.get(n)}"
        for n in sorted(set(actual_types) | set(expected_types))
        if actual_types.get(n) != expected_types.get(n)
    ]
    if found:
        return found
    names = sorted(actual_types)
    actual = Counter(_rows(result.select(*names).collect()))
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = Counter(_rows(connection.sql(f"SELECT {quoted} FROM ({sql})").fetchall()))
    surplus, lacking = actual - expected, expected - actual
    if surplus or lacking:
        found.append(f"{sum(actual.values())} rows instead of {sum(expected.values())}, columns {names}")
        found += [f"only Spark: {row}" for row in list(surplus)[:3]]
        found += [f"only SQL:   {row}" for row in list(lacking)[:3]]
    return found


def _rows(rows) -> list[tuple]:
    return [tuple(_value(v) for v in row) for row in rows]


def _value(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return (value, math.copysign(1.0, value)) if value == 0 else value
    if isinstance(value, Decimal):
        return str(value)
    return value
