"""The registry of queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.functions.time import iso
from faultloom.session import pin_utc

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query. The wrapped run fixes the session's time zone first."""

    def add(run: Run) -> Run:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return run(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(prepared, oracle)
        return run

    return add


def flat(df: DataFrame) -> DataFrame:
    """Arrays as joined text, instants as ISO text, long bodies as digests: easy to compare."""
    out: list[Column] = []
    for field in df.schema:
        column = F.col(field.name)
        kind = field.dataType.simpleString()
        if kind == "array<string>":
            column = F.array_join(column, ",")
        elif kind == "timestamp":
            column = iso(column)
        out.append(column.alias(field.name))
    return df.select(*out).withColumns({c: F.md5(c) for c in df.columns if c == "body"})


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_in(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def sql_text(value: str | None) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'"


def sql_iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ')"
