"""Continuous intake: landed files in, an upserted table of raw issues out.

The table is a log. Every micro-batch writes its own directory, overwritten
when the batch is retried, so a lost executor or a restart leaves no
duplicates and no batch rewrites what earlier ones wrote. Reading takes the
newest row per issue. ``compact`` folds the log from time to time: it writes a
directory of its own, whose success marker commits it. Readers take the last
folded directory that has one and the batches after it; nothing that is read is
ever renamed, so a compaction may stop anywhere.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from faultloom.operators.intake import FailureTerms, keep_failures
from faultloom.schemas import RAW_ISSUE, empty
from faultloom.sources import fs
from faultloom.sources.payloads import good_rows, quarantine, type_payloads

BATCH, FOLDED = "batch_id", "folded"
#: Up to so many partitions Spark writes a shuffle without holding rows (spark.shuffle.sort.bypassMergeThreshold).
SPREAD = 200


def _latest(rows: DataFrame) -> DataFrame:
    """The newest version of each issue. Spark ranks within partitions before the shuffle."""
    newest = Window.partitionBy("node_id").orderBy(
        F.desc_nulls_last("updated_at"),
        F.desc(BATCH),
        F.desc(F.xxhash64(*RAW_ISSUE.names)),
    )
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def _spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly, whatever they hold.

    A file may be one block that a single task reads whole. Ranked there, all its rows
    would be sorted in that task's memory; dealt out by their number, they
    are sorted in parts of a shuffle's usual size, equal rows and all.
    """
    dealt, by = rows.withColumn("_row", F.monotonically_increasing_id()), ["_row"]
    if int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) > SPREAD:
        by = [SPREAD, *by]
    return dealt.repartition(*by).drop("_row")


def write_batch(rows: DataFrame, batch_id: int, table: str) -> None:
    """Put one micro-batch into the log, one row per issue."""
    rows = _latest(_spread(rows.select(*RAW_ISSUE.names)).withColumn(BATCH, F.lit(batch_id).cast("long")))
    rows.drop(BATCH).write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")


def _live(spark: SparkSession, table: str) -> tuple[str | None, list[int], list[str]]:
    """The last committed fold, the batches after it, and the directories they make superfluous."""
    names = fs.subdirs(spark, table)
    folds = [
        (int(name.split("-")[1]), name)
        for name in names
        if name.startswith(FOLDED) and fs.exists(spark, f"{table}/{name}/_SUCCESS")
    ]
    upto, fold = max(folds, default=(None, None))
    ids = sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{BATCH}="))
    after = [i for i in ids if upto is None or i > upto]
    old = [f"{BATCH}={i}" for i in ids if i not in after] + [n for _, n in folds if n != fold]
    return fold, after, old


def _log(spark: SparkSession, table: str, fold: str | None, batches: list[int]) -> DataFrame:
    """Rows of the log with the batch they came with."""
    schema = StructType([*RAW_ISSUE.fields, StructField(BATCH, LongType())])
    rows = empty(spark, schema)
    if batches:
        paths = [f"{table}/{BATCH}={i}" for i in batches]
        rows = spark.read.schema(schema).option("basePath", table).parquet(*paths)
    if fold is not None:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{table}/{fold}"))
    return rows


def read_upserted(spark: SparkSession, table: str) -> DataFrame:
    """The current rows of an upserted table."""
    fold, batches, _ = _live(spark, table)
    return _latest(_log(spark, table, fold, batches)).drop(BATCH)


def compact(spark: SparkSession, table: str) -> None:
    """Fold all batches but the last into one directory. Run it between streaming runs.

    The last batch keeps its directory: a stream that stopped in the middle of
    it writes it again. What the fold before this one had replaced is deleted, so
    readers that started before this compaction still find their files.
    """
    fold, batches, old = _live(spark, table)
    if len(batches) < 2:
        return
    rows = _latest(_log(spark, table, fold, batches[:-1]))
    rows.write.parquet(f"{table}/{FOLDED}-{batches[-2]}-{uuid.uuid4().hex}")
    for name in old:
        fs.delete(spark, f"{table}/{name}")


def failures(payloads: DataFrame, terms: FailureTerms = FailureTerms()) -> DataFrame:
    """Typed failure reports of a payload stream. Stateless, so it runs on streams as on tables."""
    return keep_failures(good_rows(type_payloads(payloads)), terms)


def start_intake(
    payloads: DataFrame,
    table: str,
    checkpoint: str,
    terms: FailureTerms = FailureTerms(),
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Upsert all payloads that are there now, then stop: the scheduled form of the job."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        typed = type_payloads(batch)
        write_batch(keep_failures(good_rows(typed), terms), batch_id, table)
        if quarantine_path:
            bad = quarantine(typed)
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/{BATCH}={batch_id}")

    return (
        payloads.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_upsert(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Upsert a stream of raw issues."""
    return (
        rows.writeStream.foreachBatch(lambda batch, i: write_batch(batch, i, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_cursors(issues: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest update per framework as streaming state.

    The state has a row per framework. Each batch writes the frameworks that
    moved; the greatest value per framework over all batches is the cursor.
    """
    moved = issues.groupBy(F.col("framework_slug").alias("slug")).agg(
        F.max("updated_at").alias("last_scraped_at")
    )

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        moved.writeStream.outputMode("update")
        .foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The cursors a stream has kept."""
    return (
        spark.read.parquet(path).groupBy("slug").agg(F.max("last_scraped_at").alias("last_scraped_at"))
    )
