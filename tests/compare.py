"""Compare a query with its DuckDB statement: names, types and values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import duckdb

SOURCES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in SOURCES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime | date):
        return value.isoformat()
    return value


def _rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(result, connection, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    for name, kind in result.dtypes:
        if SAME.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    ordered = sorted(names)
    expected = _rows(cursor.fetchall(), [names.index(n) for n in ordered])
    actual = _rows(result.collect(), [result.columns.index(n) for n in ordered])
    if len(expected) != len(actual):
        return f"{len(actual)} rows against {len(expected)}"
    for got, want in zip(actual, expected, strict=True):
        if got != want:
            return f"{dict(zip(ordered, got))} against {dict(zip(ordered, want))}"
    return None
