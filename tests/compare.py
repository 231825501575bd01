"""Side-by-side comparison of a Spark result and its DuckDB equivalent."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(result, connection, sql: str) -> tuple[Counter, Counter]:
    """Rows only Spark has, and rows only DuckDB has."""
    cursor = connection.execute(sql)
    columns = [item[0] for item in cursor.description]
    assert sorted(columns) == sorted(result.columns), (columns, result.columns)
    ours = bag(result.columns, result.collect())
    theirs = bag(columns, cursor.fetchall())
    return ours - theirs, theirs - ours
