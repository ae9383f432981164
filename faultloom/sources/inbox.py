"""Landed payloads of which each file is read once.

A stream with a checkpoint copies the files that landed since its last call into
the inbox, a folder for each micro-batch; a run takes the batches that no run
before it has finished, and marks them when it is done. So a run reads no file that
an earlier one has read, and a run that dies finds the same batches again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.schemas import PAYLOAD, empty
from faultloom.sources import fs
from faultloom.sources.payloads import stream_landing

BATCH = "batch_id"
_MARK = T.StructType([T.StructField("upto", T.LongType())])


def fill(spark: SparkSession, landing: str, inbox: str, max_files_per_trigger: int | None = None) -> int:
    """Read what has landed since the last call, all of it, and return the number of payloads.

    A batch that is tried again writes its folder again.
    """
    query = (
        stream_landing(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(lambda rows, i: rows.write.mode("overwrite").parquet(f"{inbox}/{BATCH}={i}"))
        .option("checkpointLocation", f"{inbox}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def _batches(spark: SparkSession, inbox: str) -> list[int]:
    names = fs.subdirs(spark, inbox)
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}="))


def _finished(spark: SparkSession, inbox: str) -> int:
    found = fs.current_version(spark, f"{inbox}/finished")
    return -1 if found is None else spark.read.schema(_MARK).parquet(found).first()["upto"]


def waiting(spark: SparkSession, inbox: str) -> tuple[DataFrame, int]:
    """The payloads that no finished run has taken, and the batch they reach to."""
    upto = _finished(spark, inbox)
    fresh = [i for i in _batches(spark, inbox) if i > upto]
    paths = [f"{inbox}/{BATCH}={i}" for i in fresh]
    rows = spark.read.schema(PAYLOAD).parquet(*paths) if paths else empty(spark, PAYLOAD)
    return rows, max(fresh, default=upto)


def finish(spark: SparkSession, inbox: str, upto: int) -> None:
    """No later run takes batches up to this one. Those finished before it are deleted."""
    before = _finished(spark, inbox)
    fs.write_version(spark.range(1).select(F.lit(upto).cast("long").alias("upto")), f"{inbox}/finished")
    for i in _batches(spark, inbox):
        if i <= before:
            fs.delete(spark, f"{inbox}/{BATCH}={i}")
