"""Evaluation jobs: relabel a sample, compare two label tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession

from faultloom.operators import agreement, curation, labelling, rows, sampling
from faultloom.schemas import AXES
from faultloom.session import materialize
from faultloom.sources import snapshots


def relabel(
    issues: DataFrame,
    factory: labelling.LabellerFactory,
    model: str,
    *,
    sample_size: int | None = None,
    stratum: str | None = "framework_slug",
    seed: int = 42,
    tries: int = 3,
    parallelism: int | None = None,
    classified_at: Column | None = None,
) -> DataFrame:
    """Label a sample of an existing table again; rows that fail are left out."""
    sample = issues
    if sample_size is not None:
        sample = sampling.stratified_sample(issues, sample_size, stratum=stratum, seed=seed)
    sample = materialize(rows.raw_from_issues(sample), "sample")
    labelled = labelling.label_prompts(
        rows.prompts_with_rows(sample), factory, tries=tries, parallelism=parallelism
    )
    found = labelling.accepted_rows(materialize(labelled, "relabels"))
    return rows.relabelled(rows.with_labels(found), model, classified_at)


def compare(
    spark: SparkSession,
    primary: str,
    secondary: str,
    report: str,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
) -> dict[str, Any]:
    """Kappa report of two Parquet label tables, written as JSON and returned."""
    a, b = spark.read.parquet(primary), spark.read.parquet(secondary)
    result = materialize(agreement.kappa_report(a, b, axes, join_on), "kappa")
    agreement.report_json(result).coalesce(1).write.mode("overwrite").text(report)
    return agreement.collect_report(result)


def published_diff(spark: SparkSession, corpus: str, old: str | None, new: str | None) -> DataFrame:
    """What was added or removed between two published revisions (None: main), as ``curation.revision_diff`` tells it.

    Issues are compared in the buckets whose digests differ, frameworks by the lists
    of parts; all other buckets are not read.
    """
    issues = snapshots.changed_issues(spark, corpus, old, new)
    slugs, labels = (
        [get(revision) for revision in (old, new)]
        for get in (
            lambda r: snapshots.listed_frameworks(spark, corpus, r),
            lambda r: snapshots.read_table(spark, snapshots.corpus_table(corpus, r, "taxonomy"), "taxonomy"),
        )
    )
    return curation.diff({
        "issues": (*issues, ["node_id"]),
        "frameworks": (*slugs, ["framework_slug"]),
        "taxonomy": (*labels, ["axis", "label", "definition"]),
    })
