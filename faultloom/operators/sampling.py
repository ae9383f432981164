"""Exact-size sampling, plain and stratified.

Rows are ordered by a seeded hash of their key, so a sample is repeatable and
does not depend on partitioning. The first 3 hex digits of the hash put rows
into 4,096 buckets. Counting per bucket finds the bucket where a sample of the
wanted size ends. Only keys and hashes of that bucket are ranked, which gives
the last (hash, key) of the sample. Rows up to this bound are then filtered in
the scan; the table itself is never shuffled.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.session import materialize

log = logging.getLogger(__name__)

_BUCKET_DIGITS = 3


def sample_order(key: str, seed: int) -> Column:
    """The seeded hash that rows are sampled in the order of. A row without key comes first."""
    return F.coalesce(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.lit(""))


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.withColumn("_h", sample_order(key, seed)).withColumn(
        "_b", F.substring("_h", 1, _BUCKET_DIGITS)
    )


def _bucket_counts(df: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """Rows per group and bucket: at most 4,096 rows per group, from key and group columns only."""
    return _hashed(df.select(*by, key), key, seed).groupBy(*by, "_b").agg(F.count("*").alias("_n"))


def _bounds(df: DataFrame, counts: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """The last place of each group's sample, a row for each group that has more rows than its target.

    ``_last`` is the (hash, key) there, ``_need`` how many of the ``_ties`` rows
    with just this hash and key belong to the sample.
    """
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_b"))
    cuts = (
        counts.withColumn("_upto", upto)
        .withColumn("_room", F.col("target") - (F.col("_upto") - F.col("_n")))
        .filter((F.col("_room") > 0) & (F.col("_room") <= F.col("_n")))
        .select(*by, F.col("_b").alias("_cut"), "_room")
    )
    keys = _join_null_safe(_hashed(df.select(*by, key), key, seed), F.broadcast(cuts), by)
    place = F.struct("_h", key)
    ranked = keys.filter(F.col("_b") == F.col("_cut")).withColumn("_place", place)
    ranked = ranked.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_place")))
    last = F.max(F.when(F.col("_rank") == F.col("_room"), F.col("_place")))
    ranked = ranked.withColumn("_last", last.over(Window.partitionBy(*by)))
    tied = ranked.filter(F.col("_place") == F.col("_last"))
    return tied.groupBy(*by).agg(
        F.first("_last").alias("_last"),
        F.count("*").alias("_ties"),
        F.count_if(F.col("_rank") <= F.col("_room")).alias("_need"),
    )


def _take(df: DataFrame, counts: DataFrame, by: list[str], key: str, seed: int) -> DataFrame:
    """The first ``target`` rows in sample order of each group.

    ``counts`` are bucket counts with a ``target`` column of 1 and more. The
    bounds, a row per group, are written and broadcast. Only where rows repeat
    the last key of a sample are these few ranked.
    """
    bounds = materialize(_bounds(df, counts, by, key, seed), "sample-bounds")
    rows = _hashed(df, key, seed)
    if by:
        rows = _join_null_safe(rows, F.broadcast(bounds), by, "left")
    else:
        rows = rows.join(F.broadcast(bounds), F.lit(True), "left")
    place = F.struct("_h", key)
    kept = rows.filter(F.col("_last").isNull() | (place <= F.col("_last")))
    if not bounds.filter("_ties > _need").take(1):
        return kept.select(*df.columns)
    tied = F.coalesce((place == F.col("_last")) & (F.col("_ties") > F.col("_need")), F.lit(False))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64(*df.columns)))
    some = kept.filter(tied).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_need"))
    return kept.filter(~tied).select(*df.columns).union(some.select(*df.columns))


def _join_null_safe(
    left: DataFrame, right: DataFrame, by: list[str], how: str = "inner"
) -> DataFrame:
    """Join on columns that may be null, null matching null."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in by],
        *[c for c in right.columns if c not in by],
    )
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, on, how).drop(*[f"_r_{c}" for c in by])


def random_sample(df: DataFrame, n: int, *, key: str = "node_id", seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows, or all of them where there are fewer."""
    if n <= 0:
        return df.limit(0)
    counts = _bucket_counts(df, [], key, seed).withColumn("target", F.lit(n))
    return _take(df, counts, [], key, seed)


def _shave(rows: DataFrame, value: str, excess: str, result: str) -> DataFrame:
    """Take ``excess`` units off the tallest of the values, always from the tallest.

    Equivalent to removing one unit at a time from the largest value, the first
    row in ``_order`` on ties. The tallest ``j`` rows end level with each other;
    ``j`` is the first count whose leveling to the next value frees enough.
    Runs over one row per stratum.
    """
    tallest = Window.orderBy(F.desc(value), "_order")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = F.sum(value).over(tallest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.coalesce(F.lead(value).over(tallest), F.lit(0))
    ranked = (
        rows.withColumn("_j", F.row_number().over(tallest))
        .withColumn("_top", running)
        .withColumn("_frees", F.col("_top") - F.col("_j") * following)
    )
    enough = F.when(F.col("_frees") >= F.col(excess), F.col("_j"))
    ranked = ranked.withColumn("_cutoff", F.min(enough).over(everything))
    left = F.max(F.when(F.col("_j") == F.col("_cutoff"), F.col("_top"))).over(everything)
    ranked = ranked.withColumn("_left", left - F.col(excess)).withColumn(
        "_leveled", (F.col("_j") <= F.col("_cutoff")) & (F.col(excess) > 0)
    )
    # Earlier rows give a unit first, so the spare units stay with the last leveled rows.
    from_last = F.row_number().over(Window.partitionBy("_leveled").orderBy(F.desc("_order")))
    level = F.floor(F.col("_left") / F.col("_cutoff"))
    spare = F.col("_left") - level * F.col("_cutoff")
    shaved = level + F.when(from_last <= spare, F.lit(1)).otherwise(F.lit(0))
    return ranked.withColumn(
        result, F.when(F.col("_leveled"), shaved).otherwise(F.col(value)).cast("long")
    ).drop("_j", "_top", "_frees", "_cutoff", "_left", "_leveled")


def allocate(sizes: DataFrame, n: int, *, stratum: str, weight: str | None = None) -> DataFrame:
    """Targets per stratum that add up to exactly ``n``: (stratum, size, target).

    Each stratum gets its proportional share, rounded half to even, at least 1
    and at most its size. What is then too much comes off the largest targets;
    what is missing goes to the strata with most rows left. ``sizes`` has the
    stratum, its ``size`` and, if named, a ``weight`` that replaces size in the
    shares. Ties go by size, then stratum. With fewer units than strata, or
    fewer rows than units, every stratum keeps a target of at most its size and
    at least 1, so the caller picks another way first.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share_of = weight or "size"
    share = F.bround(F.lit(n) * F.col(share_of) / F.sum(share_of).over(everything), 0).cast("long")
    start = (
        sizes.withColumn(
            "_order", F.row_number().over(Window.orderBy(F.desc("size"), F.asc_nulls_last(stratum)))
        )
        .withColumn("_t", F.greatest(F.lit(1), F.least("size", share)))
        .withColumn("_sum", F.sum("_t").over(everything))
        .withColumn("_over", F.greatest(F.col("_sum") - n, F.lit(0)))
    )
    lowered = _shave(start, "_t", "_over", "_t1")
    spare = lowered.withColumn("_slack", F.col("size") - F.col("_t1")).withColumn(
        "_under", F.greatest(F.lit(n) - F.sum("_t1").over(everything), F.lit(0))
    )
    raised = _shave(spare, "_slack", "_under", "_slack1")
    return raised.select(stratum, "size", (F.col("size") - F.col("_slack1")).alias("target"))


def stratum_sizes(df: DataFrame, stratum: str) -> DataFrame:
    return df.groupBy(stratum).agg(F.count("*").alias("size"))


def stratified_sample(
    df: DataFrame, n: int, *, stratum: str | None, key: str = "node_id", seed: int = 42
) -> DataFrame:
    """Exactly ``n`` rows with every stratum present, or all rows where there are fewer.

    Without a stratum, or (with a warning) with more strata than ``n``, the sample is plain.
    Null is a stratum like any other. Bucket counts are written to the shared
    folder first, at most 4,096 rows per stratum; the number of rows and strata
    that decide between these cases is read from them.
    """
    if stratum is None:
        return random_sample(df, n, key=key, seed=seed)
    counts = materialize(_bucket_counts(df, [stratum], key, seed), "bucket-counts")
    sizes = counts.groupBy(stratum).agg(F.sum("_n").alias("size"))
    return _stratified(df, n, counts, sizes, stratum, None, key, seed)


def _stratified(
    df: DataFrame,
    n: int,
    counts: DataFrame,
    sizes: DataFrame,
    stratum: str,
    weight: str | None,
    key: str,
    seed: int,
) -> DataFrame:
    groups, rows = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if n >= rows:
        return df
    if n < groups:
        log.warning("a sample of %d cannot hold all %d strata of %s; it is plain instead", n, groups, stratum)
        return random_sample(df, n, key=key, seed=seed)
    targets = allocate(sizes, n, stratum=stratum, weight=weight).select(stratum, "target")
    return _take(df, _join_null_safe(counts, targets, [stratum]), [stratum], key, seed)


def oversampled(
    df: DataFrame,
    n: int,
    *,
    weight: Column,
    strata: list[str],
    key: str = "node_id",
    seed: int = 42,
) -> DataFrame:
    """A stratified sample over a composite stratum, shares set by a weight.

    A stratum's share follows the sum of its rows' weights instead of their
    number, so rows worth looking at (flagged for review, disputed) get more room.
    """
    composite = F.struct(*[F.col(c).cast("string") for c in strata])
    tagged = df.withColumn("_stratum", composite)
    counts = (
        _hashed(tagged.withColumn("_weight", weight), key, seed)
        .groupBy("_stratum", "_b")
        .agg(F.count("*").alias("_n"), F.sum("_weight").alias("_w"))
    )
    counts = materialize(counts, "bucket-counts")
    sizes = counts.groupBy("_stratum").agg(F.sum("_n").alias("size"), F.sum("_w").alias("weight"))
    found = _stratified(
        tagged, n, counts.drop("_w"), sizes, "_stratum", "weight", key, seed
    )
    return found.select(*df.columns)
