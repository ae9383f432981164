"""Run a registered query and its SQL and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def kinds(row) -> list[str]:
    return [type(v).__name__ for v in row]


def compare(spark, name: str, run, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = run(spark, sf_dir)
    got_columns = df.columns
    got = [tuple(r) for r in df.collect()]
    con = connect(sf_dir)
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"{name}: columns {sorted(got_columns)} != {sorted(want_columns)}"
    if not want:
        return f"{name}: the oracle has no rows"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if a != b:
        extra, missing = list((a - b).items())[:3], list((b - a).items())[:3]
        return (
            f"{name}: {len(got)} rows, oracle {len(want)};"
            f" {sum((a - b).values())} only in Spark, such as {extra};"
            f" {sum((b - a).values())} only in SQL, such as {missing}"
        )
    first_got = dict(zip(got_columns, got[0], strict=True))
    for column, value in zip(want_columns, want[0], strict=True):
        mine = first_got[column]
        if None not in (mine, value) and type(mine) is not type(value):
            return f"{name}: {column} is {type(mine).__name__}, oracle {type(value).__name__}"
    return None
