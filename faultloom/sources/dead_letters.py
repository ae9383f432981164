"""Rows a run could not use, kept for another try.

A dead-letter table is versioned: each run writes what is left after it. A row has
the reason, the number of attempts so far and the run that saw it first. Rows with
fewer attempts than allowed are folded into the next run; the others stay for
people to look at. A row that a run could use is in no later version, so nothing
is replayed twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.schemas import PAYLOAD, RAW_ISSUE, empty
from faultloom.sources import fs

_FATE = [
    T.StructField("reason", T.StringType()),
    T.StructField("attempts", T.LongType()),
    T.StructField("first_run", T.StringType()),
]
#: Payloads that could not be typed, and issues that could not be labelled.
KINDS = {"payloads": T.StructType([*PAYLOAD.fields, *_FATE]), "issues": T.StructType([*RAW_ISSUE.fields, *_FATE])}
FATE = [f.name for f in _FATE]


def read(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """All rows of a kind that are left."""
    found = fs.current_version(spark, f"{path}/{kind}")
    return empty(spark, KINDS[kind]) if found is None else spark.read.schema(KINDS[kind]).parquet(found)


def may_retry(max_attempts: int) -> Column:
    return F.col("attempts") < max_attempts


def write(rows: DataFrame, path: str, kind: str) -> None:
    """The rows that are left after a run. They may be computed from those before it."""
    fs.write_version(rows.select(*KINDS[kind].names), f"{path}/{kind}")


def counted(failed: DataFrame, reason: str, run_id: str) -> DataFrame:
    """Rows that failed just now, with one attempt more than they came with (none, if new)."""
    return failed.withColumns({
        "reason": F.col(reason),
        "attempts": F.coalesce("attempts", F.lit(0).cast("long")) + 1,
        "first_run": F.coalesce("first_run", F.lit(run_id)),
    })
