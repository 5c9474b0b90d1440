"""Run a query in Spark and its SQL twin in DuckDB and compare all rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str:
    """Empty when names, row counts and values agree."""
    got_columns = spark_df.columns
    got = spark_df.collect()
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    a, b = rows_of(got_columns, got), rows_of(want_columns, want)
    if a == b:
        return ""
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    return (
        f"{sorted(got_columns)}: {len(got)} rows in Spark, {len(want)} in SQL; "
        f"{len(only_a)} only in Spark {only_a[:2]}, {len(only_b)} only in SQL {only_b[:2]}"
    )
