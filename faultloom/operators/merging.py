"""Merging runs and shards into one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.schemas import ISSUES, conform
from faultloom.session import materialize


#: Rows from which an issue may be loud, and the share of all rows that fewer issues than this can each have.
LOUD_ROWS, LOUD_IDS = 10_000, 10_000


def _newest_per_issue(rows: DataFrame, *dealt: str) -> DataFrame:
    """One row per issue: the latest label, then the new side, then the latest update.

    A hash over the row settles what is left, so the result does not depend on
    row order. Spark ranks inside each partition before the shuffle (rank
    limit 1), so an issue with very many versions arrives as a few rows. Rows that
    are ``dealt`` by columns made of the id alone are ranked where they lie.
    """
    tie = F.xxhash64(*[c for c in rows.columns if c not in ("_new", *dealt)])
    newest = Window.partitionBy(*dealt, "node_id").orderBy(
        F.desc_nulls_last("classified_at"),
        F.desc("_new"),
        F.desc_nulls_last("updated_at"),
        F.desc("_tie"),
    )
    return (
        rows.withColumn("_tie", tie)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_tie", "_new")
    )


def merge_latest(
    new: DataFrame,
    existing: DataFrame | None,
    *,
    existing_unique: bool = False,
    strict_reference: bool = False,
) -> DataFrame:
    """Union of two issue tables with the newest row of every issue.

    ``existing_unique`` says the existing table has a row per issue. Then only
    the rows the new side touches are ranked; the rest passes through without
    being sorted, and where the new side is small Spark broadcasts its keys.

    ``strict_reference`` keeps one quirk of the published data: with nothing
    existing, the new side passes unchanged, duplicates included.
    """
    if existing is None:
        return new if strict_reference else _newest_per_issue(new.withColumn("_new", F.lit(1)))
    if strict_reference and existing.isEmpty():
        return new
    tagged_new = new.withColumn("_new", F.lit(1))
    tagged_old = existing.withColumn("_new", F.lit(0))
    if not existing_unique:
        return _newest_per_issue(tagged_old.unionByName(tagged_new))
    keys = new.select("node_id").distinct()
    touched = tagged_old.join(keys, "node_id", "left_semi")
    untouched = existing.join(keys, "node_id", "left_anti")
    merged = untouched.unionByName(_newest_per_issue(touched.unionByName(tagged_new)))
    return merged.select(*existing.columns)


def _loud_ids(rows: DataFrame) -> DataFrame | None:
    """Ids that have so many rows that one task should not get them all; None where there are none. They are few."""
    total = rows.count()
    if total <= LOUD_ROWS:
        return None
    loud = rows.groupBy("node_id").agg(F.count("*").alias("n")).filter(
        F.col("n") > max(LOUD_ROWS, total // LOUD_IDS)
    )
    loud = materialize(loud.select(F.col("node_id").alias("_loud")), "loud-ids")
    return loud if loud.take(1) else None


def merge_dealt(new: DataFrame, existing: DataFrame, bucket: str, of_id: Column) -> DataFrame:
    """``merge_latest`` of tables of which none is unique, dealt by ``bucket``, a column made of the id.

    Rows are shuffled once, for the ranking and the buckets alike. Only those of an
    issue with very many are ranked before that, so they reach its bucket as one.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    loud = _loud_ids(both)
    if loud is not None:
        same = F.col("node_id").eqNullSafe(F.col("_loud"))
        many = both.join(F.broadcast(loud), same, "left_semi")
        # Of an issue that is ranked, the side no longer matters.
        first = _newest_per_issue(many).withColumn("_new", F.lit(1))
        both = both.join(F.broadcast(loud), same, "left_anti").unionByName(first)
    return _newest_per_issue(both.withColumn(bucket, of_id).repartition(bucket), bucket)


def union_shards(*shards: DataFrame) -> DataFrame:
    """All rows of all shards, duplicates included, on the declared schema."""
    first, *rest = [conform(shard, ISSUES) for shard in shards]
    for shard in rest:
        first = first.unionByName(shard)
    return first


def shard_revisions(rows: DataFrame) -> DataFrame:
    """How many revisions a set of shard rows spans, and whether that is one."""
    return rows.agg(F.count_distinct("revision").alias("revisions"), F.count("*").alias("n_rows")).select(
        "revisions", "n_rows", (F.col("revisions") == 1).alias("consistent")
    )
