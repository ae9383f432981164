"""Landed issue payloads: JSON lines, read as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.dims import frameworks
from faultloom.functions.time import parse_iso
from faultloom.schemas import PAYLOAD, RAW_ISSUE, STATES, conform

# The column of a typed payload row that says what is wrong with it.
PROBLEM = "problem"

_REQUIRED = ("number", "node_id", "title", "html_url", "state")
_REPOSITORY_IN_URL = r"^https?://[^/]+/([^/]+/[^/]+)/"


def read_landing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All payloads under the given paths, one read for every framework."""
    return spark.read.schema(PAYLOAD).json(paths)


def stream_landing(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same payloads as a stream of files not seen before."""
    reader = spark.readStream.schema(PAYLOAD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _problem() -> Column:
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in _REQUIRED]
    return F.coalesce(
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("malformed JSON")),
        *missing,
        F.when(~F.col("state").isin(*STATES), F.lit("unknown state")),
        F.when(parse_iso(F.col("created_at")).isNull(), F.lit("bad created_at")),
        F.when(parse_iso(F.col("updated_at")).isNull(), F.lit("bad updated_at")),
        F.when(
            F.col("closed_at").isNotNull()
            & (F.col("closed_at") != "")
            & parse_iso(F.col("closed_at")).isNull(),
            F.lit("bad closed_at"),
        ),
        F.when(
            F.exists(F.coalesce("labels", F.array()), lambda x: x["name"].isNull()),
            F.lit("label without name"),
        ),
        F.when(F.col("framework_slug").isNull(), F.lit("unknown repository")),
    )


def type_payloads(
    payloads: DataFrame, known: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed rows plus a ``problem`` column, null on good rows, and the columns named in ``keep``.

    The framework comes from the repository in the payload's URL. The
    frameworks dimension has a row per framework and is always broadcast.
    """
    known = frameworks(payloads.sparkSession) if known is None else known
    slugs = known.select(
        F.lower("repo").alias("_repo"), F.col("slug").alias("framework_slug")
    )
    found = F.lower(F.regexp_extract("html_url", _REPOSITORY_IN_URL, 1))
    rows = payloads.withColumn("_repo", found).join(F.broadcast(slugs), "_repo", "left")
    return rows.select(
        "framework_slug",
        F.col("number").alias("issue_number"),
        "node_id",
        "title",
        "body",
        F.col("html_url").alias("url"),
        F.coalesce("labels.name", F.array().cast("array<string>")).alias("labels"),
        "state",
        "author_association",
        F.col("pull_request").isNotNull().alias("is_pull_request"),
        parse_iso(F.col("created_at")).alias("created_at"),
        parse_iso(F.col("updated_at")).alias("updated_at"),
        parse_iso(F.col("closed_at")).alias("closed_at"),
        F.coalesce("comments", F.lit(0)).alias("comment_count"),
        _problem().alias(PROBLEM),
        F.col("_corrupt_record").alias("payload"),
        *keep,
    )


def good_rows(typed: DataFrame) -> DataFrame:
    """The raw issues among typed payload rows."""
    return conform(typed.filter(F.col(PROBLEM).isNull()), RAW_ISSUE)


def quarantine(typed: DataFrame) -> DataFrame:
    """The other rows, with the reason each was set aside."""
    return typed.filter(F.col(PROBLEM).isNotNull())
