"""Runs registered queries beside their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return float(f"{float(value):.12g}")
    if isinstance(value, (bytes, bytearray)):
        return value.decode()
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value) if isinstance(value, datetime.date) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def _kind(type_name: str) -> str:
    """Type family under which Spark and DuckDB names meet."""
    name = type_name.lower().split("(")[0]
    families = {
        "integer": ("int", "integer", "bigint", "smallint", "hugeint"),
        "text": ("string", "varchar"),
        "time": ("timestamp_ntz", "timestamp", "timestamp_ns"),
    }
    return next((f for f, names in families.items() if name in names), name)


def compare(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    for field in df.schema:
        kind = _kind(field.dataType.simpleString())
        if kind != kinds[field.name]:
            return f"type of {field.name}: {kind} != {kinds[field.name]}"
    expected = _rows(columns, result.fetchall())
    actual = _rows(df.columns, df.collect())
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{a} != {e}"
    return None
