"""Compare a Spark result with the rows its SQL gives in DuckDB."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9)
    if isinstance(value, Decimal):
        return round(float(value), 9)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _bag(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result: DataFrame, connection, sql: str) -> str | None:
    """None if both hold the same columns and rows, else what differs."""
    cursor = connection.execute(sql)
    names, expected = _bag([column[0] for column in cursor.description], cursor.fetchall())
    ours, actual = _bag(result.columns, [tuple(row) for row in result.collect()])
    if ours != names:
        return f"columns {ours} != {names}"
    if actual != expected:
        missing, extra = expected - actual, actual - expected
        return (
            f"{sum(actual.values())} rows for {sum(expected.values())}; "
            f"missing {list(missing.items())[:3]}; extra {list(extra.items())[:3]}"
        )
    return None
