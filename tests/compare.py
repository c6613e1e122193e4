"""Run queries and their SQL side by side."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB session with every table of the folder as a view."""
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def normal(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value == int(value) else float(f"{value:.9g}")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())
