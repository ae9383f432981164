"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Whether Spark removes a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings every job here relies on.

    ``master`` stays unset on a cluster, where spark-submit names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Instants are stored and rendered in UTC whatever the host's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session, where every task runs on this machine, gets one made
    if the setting is missing.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    base = tempfile.mkdtemp(prefix="faultloom-")
    spark.conf.set(CHECKPOINT_DIR, base)
    return base


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_dir(spark), f"faultloom-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(_scratch_root(spark), f"{tag}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder. Call it when all results are out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later reads start from the files: nothing before them is computed again,
    whichever executors are lost meanwhile. The shuffle files of the write go
    when it ends, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
