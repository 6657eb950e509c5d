"""Runs a registered query and its SQL answer and compares them value by value."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from deskflow.sources.tables import SCHEMAS


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


def compare(con, df, sql: str) -> list[str]:
    """What differs, as a list of lines; empty when the answers are equal."""
    spark_rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    sql_rows = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    if len(spark_rows) != len(sql_rows):
        problems.append(f"{len(spark_rows)} rows against {len(sql_rows)}")
    left, right = _sorted(df.columns, spark_rows), _sorted(names, sql_rows)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    kinds = {
        (type(x).__name__, type(y).__name__)
        for a, b in zip(left, right)
        for x, y in zip(a, b)
        if x is not None and y is not None and type(x) is not type(y)
    }
    if kinds:
        problems.append(f"types {sorted(kinds)}")
    if different:
        problems.append(f"{len(different)} rows differ, first {different[0]}"[:600])
    return problems
