"""Running the registered queries on Spark and their SQL on DuckDB and comparing the rows."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _cell(value):
    if isinstance(value, float):
        return (1, repr(value + 0.0)) if not math.isnan(value) else (1, "nan")
    if value is None:
        return (0, "")
    return (1, repr(value))


def _sorted_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(columns, rows, other_columns, other_rows) -> str | None:
    """None if both results hold the same rows, else what differs."""
    if sorted(columns) != sorted(other_columns):
        return f"columns {sorted(columns)} against {sorted(other_columns)}"
    if len(rows) != len(other_rows):
        return f"{len(rows)} rows against {len(other_rows)}"
    left, right = _sorted_rows(columns, rows), _sorted_rows(other_columns, other_rows)
    for mine, theirs in zip(left, right):
        if mine != theirs:
            return f"row {mine} against {theirs}"
    return None


def compare(spark_df, connection, sql: str) -> str | None:
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    rows = [tuple(row) for row in spark_df.collect()]
    return difference(spark_df.columns, rows, columns, result.fetchall())
