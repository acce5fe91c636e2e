"""Compare a Spark result with DuckDB over the same Parquet tables."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize()) if value else "0"
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return str(Decimal(value).normalize()) if value else "0"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, df.collect())


def duck_bag(con, sql: str) -> Counter:
    result = con.execute(sql)
    return bag([d[0] for d in result.description], result.fetchall())


def duck_types(con, sql: str) -> dict[str, str]:
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
