"""Compare a Spark result with DuckDB's, regardless of row order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> str | None:
    """None when both results have the same columns, types and rows."""
    result = con.sql(sql)
    expected_kinds = sorted((name, str(kind)) for name, kind in zip(result.columns, result.types))
    kinds = sorted((name, KINDS.get(kind, kind)) for name, kind in df.dtypes)
    if kinds != expected_kinds:
        return f"columns: {sorted(set(kinds) ^ set(expected_kinds))}"
    expected = _rows(result.columns, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"rows: {sum(actual.values())} != {sum(expected.values())}; "
        f"missing {list(missing.items())[:2]}; extra {list(extra.items())[:2]}"
    )
