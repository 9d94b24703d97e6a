"""Compare a query with its reference SQL: columns, row count and values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process database with one view per parquet file."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _plain(value: Any) -> Any:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. For test data: both results are fetched whole."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    expected = _bag(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(columns)}"
    actual = _bag(frame.columns, [tuple(row) for row in frame.collect()])
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra)[:3]}; missing {list(missing)[:3]}"
    )
