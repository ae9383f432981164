"""Cursors: how far each framework has been read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.functions.time import iso, parse_iso
from faultloom.schemas import CURSORS, conform, empty
from faultloom.sources import fs

# Fixed value: the name of a shard's cursor file.
STATE_FILE = "pipeline_state.json"

_STATE = T.StructType(
    [T.StructField("last_scraped_at", T.MapType(T.StringType(), T.StringType()))]
)


def read_state_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, slug, last_scraped_at) of every readable cursor file under a root.

    A file that is no JSON gives a null map, which explodes to no rows.
    """
    paths = fs.find(spark, root, STATE_FILE)
    if not paths:
        schema = T.StructType([T.StructField("file_path", T.StringType()), *CURSORS.fields])
        return empty(spark, schema)
    files = spark.read.schema(_STATE).option("multiLine", True).json(paths)
    return (
        files.select(F.col("_metadata.file_path").alias("file_path"), "last_scraped_at")
        .select("file_path", F.explode("last_scraped_at").alias("slug", "text"))
        .select("file_path", "slug", parse_iso(F.col("text")).alias("last_scraped_at"))
    )


def merge_cursors(found: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """One cursor per framework: the last file in path order wins over the base.

    A framework no file mentions keeps its base cursor.
    """
    rows = found.select("slug", "last_scraped_at", F.col("file_path").alias("_rank"))
    if base is not None:
        rows = rows.unionByName(
            base.select("slug", "last_scraped_at", F.lit("").alias("_rank"))
        )
    return rows.groupBy("slug").agg(
        F.max_by("last_scraped_at", F.struct("_rank", "last_scraped_at")).alias("last_scraped_at")
    )


def load_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The cursor table, empty before the first run."""
    found = fs.current_version(spark, path)
    return empty(spark, CURSORS) if found is None else spark.read.schema(CURSORS).parquet(found)


def save_cursors(cursors: DataFrame, path: str) -> None:
    """Write the cursors' next version. It may be computed from the last one."""
    fs.write_version(conform(cursors, CURSORS).coalesce(1), path)


def advance(cursors: DataFrame, seen: DataFrame) -> DataFrame:
    """Cursors after a run: frameworks that were seen move on, the rest stay.

    No cursor moves back, as one would by a run that takes waiting rows alone.
    """
    both = cursors.select("slug", "last_scraped_at").unionByName(seen.select("slug", "last_scraped_at"))
    return both.groupBy("slug").agg(F.max("last_scraped_at").alias("last_scraped_at"))


def as_state(cursors: DataFrame) -> DataFrame:
    """All cursors as one JSON object in the shape of a shard's cursor file. They have a row per framework."""
    entries = F.collect_list(F.struct("slug", iso(F.col("last_scraped_at")).alias("text")))
    known = cursors.filter(F.col("slug").isNotNull() & F.col("last_scraped_at").isNotNull())
    return known.agg(
        F.to_json(F.struct(F.map_from_entries(entries).alias("last_scraped_at"))).alias("value")
    )


def write_state_file(cursors: DataFrame, folder: str) -> None:
    """Put a run's cursors where the merge of shards looks for them."""
    as_state(cursors).coalesce(1).write.mode("overwrite").text(f"{folder}/{STATE_FILE}")
