"""Registered queries: the streaming jobs, whose tables must equal the batch result."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from faultloom.plans import views
from faultloom.plans.q_intake import _RAW_SQL, failure_sql, land
from faultloom.plans.registry import flat, query, sql_iso
from faultloom.plans.views import GOOD_PAYLOAD_SQL, STREAM_SQL, with_views
from faultloom.schemas import RAW_ISSUE, conform
from faultloom.session import scratch_path
from faultloom.sources import payloads
from faultloom.streaming import intake as live


@query(
    "stream_intake",
    f"""{with_views(STREAM_SQL)}
    SELECT {_RAW_SQL} FROM v_stream WHERE {GOOD_PAYLOAD_SQL} AND {failure_sql()}""",
)
def stream_intake(spark, sf_dir):
    landing = land(spark, views.stream(spark, sf_dir), "stream-landing")
    table = scratch_path(spark, "stream-table")
    found = payloads.stream_landing(spark, landing, max_files_per_trigger=2)
    live.start_intake(found, table, scratch_path(spark, "stream-state")).awaitTermination()
    return flat(live.read_upserted(spark, table))


def _versions(spark: SparkSession, sf_dir: str) -> str:
    """Raw issues where four events are versions of one issue, written as four files."""
    path = scratch_path(spark, "versions")
    issue = F.concat(F.lit("E_"), (F.col("issue_number") - F.col("issue_number") % 4).cast("string"))
    rows = views.stream(spark, sf_dir).withColumn("node_id", issue)
    rows.repartition(4, F.col("issue_number") % 4).write.parquet(path)
    return path


@query(
    "stream_upsert",
    f"""{with_views(STREAM_SQL)},
    versions AS (SELECT * REPLACE ('E_' || (issue_number - issue_number % 4) AS node_id) FROM v_stream)
    SELECT node_id, issue_number, title, {sql_iso("updated_at")} AS updated_at FROM versions
    QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY updated_at DESC) = 1""",
)
def stream_upsert(spark, sf_dir):
    rows = (
        spark.readStream.schema(RAW_ISSUE)
        .option("maxFilesPerTrigger", 1)
        .parquet(_versions(spark, sf_dir))
    )
    table = scratch_path(spark, "upsert-table")
    live.start_upsert(rows, table, scratch_path(spark, "upsert-state")).awaitTermination()
    live.compact(spark, table)
    return flat(
        live.read_upserted(spark, table).select("node_id", "issue_number", "title", "updated_at")
    )


@query(
    "stream_cursor",
    f"""{with_views(STREAM_SQL)}
    SELECT framework_slug AS slug, {sql_iso("max(updated_at)")} AS last_scraped_at
    FROM v_stream GROUP BY 1""",
)
def stream_cursor(spark, sf_dir):
    """Reads the events table itself as a stream."""
    events = (
        spark.readStream.schema(views.table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    issues = conform(events.select(*views.stream_columns()), RAW_ISSUE)
    path = scratch_path(spark, "cursors")
    live.start_cursors(issues, path, scratch_path(spark, "cursor-state")).awaitTermination()
    return flat(live.read_cursors(spark, path))
