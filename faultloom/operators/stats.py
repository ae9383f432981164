"""Corpus statistics: distributions, confidence, growth, cost."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.dims import taxonomy
from faultloom.operators.sampling import random_sample
from faultloom.schemas import AXES

# Confidence lies in [0, 1]; the median is looked for in this many slices of that range.
_SLICES = 1000


def _rate(condition: Column) -> Column:
    return F.coalesce(F.avg(condition.cast("double")), F.lit(0.0))


def axis_labels(issues: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """One row per issue and axis: (axis, label)."""
    cells = [F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("label")) for axis in axes]
    return issues.select(F.inline(F.array(*cells)))


def label_distribution(issues: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """Rows per axis and label."""
    return axis_labels(issues, axes).groupBy("axis", "label").agg(F.count("*").alias("n"))


def axis_share(issues: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """Each label's share of its axis. The counts have a row per label, so the window is small."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy("axis"))
    return label_distribution(issues, axes).withColumn("share", share)


def drift_audit(
    issues: DataFrame,
    sample_size: int = 50,
    *,
    axes: Sequence[str] = ("locus", "symptom"),
    seed: int = 42,
) -> DataFrame:
    """Label counts of an exact-size sample, with its mean confidence and review rate."""
    sample = random_sample(issues, sample_size, seed=seed)
    cells = [F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("label")) for axis in axes]
    per_label = (
        sample.select("confidence", "needs_review", F.inline(F.array(*cells)))
        .groupBy("axis", "label")
        .agg(
            F.count("*").alias("n"),
            F.sum("confidence").alias("_confidence"),
            F.count("confidence").alias("_rated"),
            F.count_if("needs_review").alias("_flagged"),
        )
    )
    # Every axis covers the whole sample, so its labels' sums add up to the sample's.
    whole = Window.partitionBy("axis")

    def total(column: str) -> Column:
        return F.sum(column).over(whole)

    return per_label.select(
        "axis",
        "label",
        "n",
        total("n").alias("sample_size"),
        F.coalesce(F.try_divide(total("_confidence"), total("_rated")), F.lit(0.0)).alias(
            "mean_confidence"
        ),
        (total("_flagged") / total("n")).alias("needs_review_rate"),
    )


def growth(revisions: DataFrame, since: Column | None = None) -> DataFrame:
    """Rows over all revisions and rows labelled since a time, by default 90 days ago.

    Revisions are cumulative, so an issue counts once in each; the number of
    different issues is given beside.
    """
    if since is None:
        since = F.current_timestamp() - F.expr("INTERVAL 90 DAYS")
    per_issue = revisions.groupBy("node_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("classified_at") >= since).alias("recent")
    )
    return per_issue.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows_across_revisions"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("classified_since"),
        F.count("*").alias("distinct_issues"),
    )


def framework_counts(issues: DataFrame) -> DataFrame:
    """Issues per framework, and the total under the framework ``Total``."""
    return (
        issues.rollup("framework_slug")
        .agg(F.count("*").alias("n_issues"), F.grouping("framework_slug").alias("_total"))
        .select(
            F.when(F.col("_total") == 1, F.lit("Total"))
            .otherwise(F.col("framework_slug"))
            .alias("framework_slug"),
            "n_issues",
        )
    )


def confidence_profile(issues: DataFrame) -> DataFrame:
    """Mean and exact median confidence, high and low shares, review rate, per framework.

    The median comes from counts. Distinct values are counted first; the slice
    of the value range that holds the middle ranks is found from the slices'
    totals, and only its values are put in order.
    """
    by = "framework_slug"
    c = F.col("confidence")
    values = (
        issues.filter(c.isNotNull())
        .groupBy(by, "confidence")
        .agg(F.count("*").alias("n"))
        .withColumn("_slice", F.floor(c * _SLICES))
    )
    slices = values.groupBy(by, "_slice").agg(F.sum("n").alias("_n_slice"))
    in_order = Window.partitionBy(by).orderBy("_slice")
    slices = (
        slices.withColumn("_upto", F.sum("_n_slice").over(in_order))
        .withColumn("_total", F.sum("_n_slice").over(Window.partitionBy(by)))
        .withColumn("_low", F.floor((F.col("_total") + 1) / 2))
        .withColumn("_high", F.floor(F.col("_total") / 2) + 1)
        .withColumn("_before", F.col("_upto") - F.col("_n_slice"))
        .filter((F.col("_upto") >= F.col("_low")) & (F.col("_before") < F.col("_high")))
        .select(by, "_slice", "_before", "_low", "_high")
    )
    upto = F.col("_before") + F.sum("n").over(Window.partitionBy(by, "_slice").orderBy("confidence"))
    ranked = values.join(slices, [by, "_slice"]).withColumn("_upto", upto)
    medians = ranked.groupBy(by).agg(
        (
            (
                F.min(F.when(F.col("_upto") >= F.col("_low"), c))
                + F.min(F.when(F.col("_upto") >= F.col("_high"), c))
            )
            / 2
        ).alias("median_confidence")
    )
    rates = issues.groupBy(by).agg(
        F.count("*").alias("n_issues"),
        F.coalesce(F.avg(c), F.lit(0.0)).alias("mean_confidence"),
        _rate(c >= 0.8).alias("high_share"),
        _rate(c < 0.5).alias("low_share"),
        _rate(F.col("needs_review")).alias("needs_review_share"),
    )
    return rates.join(medians, by, "left")


def unknown_share(issues: DataFrame, axes: Sequence[str] = AXES) -> DataFrame:
    """Share of issues with any unknown label, and per axis."""
    any_unknown = reduce(lambda a, b: a | b, [F.col(axis) == "unknown" for axis in axes])
    return issues.agg(
        F.count("*").alias("n_issues"),
        _rate(any_unknown).alias("any_unknown"),
        *[_rate(F.col(axis) == "unknown").alias(f"{axis}_unknown") for axis in axes],
    )


def usage_rollup(usage: DataFrame, prices: DataFrame, model: str = "classifier_model") -> DataFrame:
    """Tokens, cache-hit ratio and cost per model.

    Usage is summed per model before it meets the price list, which gives
    prices per million tokens: (model, cached_price, uncached_price, output_price).
    """
    sums = usage.groupBy(model).agg(
        F.count("*").alias("n_calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.sum(F.coalesce("cache_hit_tokens", F.lit(0))).alias("cache_hit_tokens"),
        F.sum(F.coalesce("cache_miss_tokens", F.lit(0))).alias("cache_miss_tokens"),
    )
    cost = (
        F.col("cache_hit_tokens") * F.col("cached_price")
        + F.col("cache_miss_tokens") * F.col("uncached_price")
        + F.col("completion_tokens") * F.col("output_price")
    ) / 1e6
    return sums.join(prices, model, "left").select(
        *sums.columns,
        F.try_divide(
            F.col("cache_hit_tokens"), F.col("cache_hit_tokens") + F.col("cache_miss_tokens")
        ).alias("cache_hit_ratio"),
        cost.alias("cost"),
        (cost / F.col("n_calls")).alias("cost_per_call"),
    )


def from_corpus(
    issues: DataFrame, corpus_id: str, axes: Sequence[str] = AXES, labels: DataFrame | None = None
) -> DataFrame:
    """(node_id, axis, label) where the label traces back to an outside corpus.

    The taxonomy has a row per label and is always broadcast.
    """
    labels = taxonomy(issues.sparkSession) if labels is None else labels
    derived = labels.filter(F.array_contains("derived_from", corpus_id)).select("axis", "label")
    cells = [F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("label")) for axis in axes]
    long = issues.select("node_id", F.inline(F.array(*cells)))
    return long.join(F.broadcast(derived), ["axis", "label"]).select("node_id", "axis", "label")


def subset(
    issues: DataFrame,
    *,
    framework: str | None = None,
    reviewed: bool = False,
    known_symptom: bool = False,
    tier: str | None = None,
    since: Column | None = None,
    until: Column | None = None,
    min_confidence: float | None = None,
) -> DataFrame:
    """The documented consumer subsets; conditions given are combined."""
    tests = [
        framework is not None and F.col("framework_slug") == framework,
        reviewed and ~F.col("needs_review"),
        known_symptom and F.col("symptom") != "unknown",
        tier is not None and F.col("classifier_tier") == tier,
        since is not None and F.col("classified_at") >= since,
        until is not None and F.col("classified_at") < until,
        min_confidence is not None and F.col("confidence") >= min_confidence,
    ]
    for test in tests:
        if test is not False:
            issues = issues.filter(test)
    return issues
