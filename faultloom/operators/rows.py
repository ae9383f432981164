"""Row shapes: composing issues, taking them apart, rendering them as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom import __version__
from faultloom.dims import TAXONOMY_ROWS, Label, system_prompt
from faultloom.functions import text as tx
from faultloom.schemas import AXES, ISSUES, RAW_ISSUE, RELABELS, conform

# The body limit of a prompt and the texts that stand for missing parts.
BODY_LIMIT = 4000
TRUNCATED = "\n\n[truncated]"
NO_LABELS = "(none)"
NO_BODY = "(empty)"
DRY_RUN_REASONING = "dry-run placeholder (classifier skipped)"


def issue_rows(
    raw: DataFrame,
    labels: DataFrame,
    *,
    tier: str,
    model: str,
    version: str = __version__,
    classified_at: Column | None = None,
) -> DataFrame:
    """Join raw issues with their labels and stamp how the labels were made.

    For labels that come in a table of their own, one row per issue.
    """
    return stamped_rows(
        raw.join(labels, "node_id"), tier=tier, model=model, version=version, classified_at=classified_at
    )


def stamped_rows(
    labelled: DataFrame,
    *,
    tier: str,
    model: str,
    version: str = __version__,
    classified_at: Column | None = None,
) -> DataFrame:
    """Raw issues that have their labels beside them, stamped."""
    stamped = labelled.withColumns(
        {
            "classifier_tier": F.lit(tier),
            "classifier_model": F.lit(model),
            "classifier_version": F.lit(version),
            "classified_at": F.current_timestamp() if classified_at is None else classified_at,
        }
    )
    return conform(stamped, ISSUES)


def dry_run_labels(raw: DataFrame) -> DataFrame:
    """Placeholder labels: everything unknown and up for review."""
    return raw.select(
        "node_id",
        *[F.lit("unknown").alias(axis) for axis in AXES],
        F.lit(0.0).alias("confidence"),
        F.lit(DRY_RUN_REASONING).alias("reasoning"),
        F.lit(True).alias("needs_review"),
    )


def dry_run_issues(raw: DataFrame, classified_at: Column | None = None) -> DataFrame:
    """Issue rows with placeholder labels. Labels are constants, so nothing is joined."""
    placeholders = {axis: F.lit("unknown") for axis in AXES}
    return conform(
        raw.withColumns(
            {
                **placeholders,
                "confidence": F.lit(0.0),
                "reasoning": F.lit(DRY_RUN_REASONING),
                "needs_review": F.lit(True),
                "classifier_tier": F.lit("dry_run"),
                "classifier_model": F.lit("dry-run"),
                "classifier_version": F.lit(__version__),
                "classified_at": F.current_timestamp() if classified_at is None else classified_at,
            }
        ),
        ISSUES,
    )


def raw_from_issues(issues: DataFrame) -> DataFrame:
    """The scraped side of issue rows; missing labels become an empty list."""
    no_labels = F.array().cast("array<string>")
    return conform(issues.withColumn("labels", F.coalesce("labels", no_labels)), RAW_ISSUE)


def relabel_rows(
    sample: DataFrame, labels: DataFrame, model: str, classified_at: Column | None = None
) -> DataFrame:
    """The output of a relabelling run, one row per issue that got a label."""
    return relabelled(
        sample.select("node_id", "framework_slug").join(labels, "node_id"), model, classified_at
    )


def relabelled(labelled: DataFrame, model: str, classified_at: Column | None = None) -> DataFrame:
    """The same from rows that have their labels beside them."""
    stamped = (
        labelled.withColumn("classifier_model", F.lit(model))
        .withColumn(
            "classified_at", F.current_timestamp() if classified_at is None else classified_at
        )
    )
    return conform(stamped, RELABELS)


def prompt_text() -> Column:
    """One raw issue as prompt text, its body cut at the limit and marked when cut."""
    body = tx.strip(tx.or_empty(F.col("body")))
    body = F.when(
        F.length(body) > BODY_LIMIT,
        F.concat(F.substring(body, 1, BODY_LIMIT), F.lit(TRUNCATED)),
    ).otherwise(body)
    labelled = F.coalesce(F.size("labels"), F.lit(0)) > 0
    return F.concat(
        F.lit("Framework: "), F.col("framework_slug"),
        F.lit("\nIssue #"), F.col("issue_number").cast("string"),
        F.lit(" ("), F.col("state"),
        F.lit(")\nLabels: "),
        F.when(labelled, F.array_join("labels", ", ")).otherwise(F.lit(NO_LABELS)),
        F.lit("\nURL: "), F.col("url"),
        F.lit("\n\nTitle: "), F.col("title"),
        F.lit("\n\nBody:\n"),
        F.when(body == "", F.lit(NO_BODY)).otherwise(body),
    )


def prompts(raw: DataFrame) -> DataFrame:
    return raw.select("node_id", prompt_text().alias("prompt"))


def prompts_with_rows(raw: DataFrame) -> DataFrame:
    """Prompts with the raw issue beside them, for a labeller to pass through."""
    return raw.select("node_id", prompt_text().alias("prompt"), F.struct(*raw.columns).alias("row"))


def with_labels(labelled: DataFrame) -> DataFrame:
    """Raw issues and labels side by side, from labelled rows that passed the issue through."""
    own = [c for c in labelled.columns if c not in ("row", "node_id")]
    return labelled.select("row.*", *own)


def prompts_with_taxonomy(raw: DataFrame, rows: Sequence[Label] = TAXONOMY_ROWS) -> DataFrame:
    """Prompts with the constant taxonomy prefix, a literal as it is the same for every row."""
    return prompts(raw).withColumn("system_prompt", F.lit(system_prompt(rows)))


def match_text() -> Column:
    """The text of an issue that linking compares."""
    return F.concat_ws(
        " ", F.col("framework_slug"), F.col("title"), tx.strip(tx.or_empty(F.col("body")))
    )


def match_texts(issues: DataFrame) -> DataFrame:
    return issues.select("node_id", match_text().alias("text"))
