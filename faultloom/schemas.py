"""Declared schemas, closed domains and the casts onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The closed label set of each axis, in published order.
LOCUS = ("model", "agent", "framework", "workflow", "platform", "unknown")
PHASE = ("planning", "action", "reflection", "memory", "coordination", "infra", "unknown")
SYMPTOM = ("wrong_output", "no_output", "cost_overrun", "crash", "security", "loop", "unknown")
ROOT_CAUSE = (
    "api_misuse",
    "api_incompatibility",
    "doc_desync",
    "model_limitation",
    "prompt_issue",
    "data_quality",
    "infrastructure",
    "unknown",
)
DOMAINS = {"locus": LOCUS, "phase": PHASE, "symptom": SYMPTOM, "root_cause": ROOT_CAUSE}
AXES = tuple(DOMAINS)

# The remaining closed domains and limits.
STATES = ("open", "closed")
TIERS = ("v4_pro", "human", "dry_run")
CORPUS_IDS = ("mast", "agentfail", "agent_error", "faults_agentic", "framework_bugs")
LINK_METHODS = ("exact_match", "semantic", "manual")
REASONING_LIMIT = 500
REVIEW_CONFIDENCE = 0.6


_STRINGS = T.ArrayType(T.StringType())
_NAMED = T.ArrayType(T.StructType().add("name", "string"))

# One landed payload. VARIANT keeps "key present but null" apart from "key absent".
PAYLOAD = (
    T.StructType()
    .add("number", "long")
    .add("node_id", "string")
    .add("title", "string")
    .add("body", "string")
    .add("html_url", "string")
    .add("labels", _NAMED)
    .add("state", "string")
    .add("author_association", "string")
    .add("created_at", "string")
    .add("updated_at", "string")
    .add("closed_at", "string")
    .add("comments", "long")
    .add("pull_request", "variant")
    .add("_corrupt_record", "string")
)

RAW_ISSUE = (
    T.StructType()
    .add("framework_slug", "string", nullable=False)
    .add("issue_number", "long", nullable=False)
    .add("node_id", "string", nullable=False)
    .add("title", "string", nullable=False)
    .add("body", "string")
    .add("url", "string", nullable=False)
    .add("labels", _STRINGS)
    .add("state", "string", nullable=False)
    .add("author_association", "string")
    .add("is_pull_request", "boolean")
    .add("created_at", "timestamp")
    .add("updated_at", "timestamp")
    .add("closed_at", "timestamp")
    .add("comment_count", "long")
)

LABELS = (
    T.StructType()
    .add("node_id", "string")
    .add("locus", "string")
    .add("phase", "string")
    .add("symptom", "string")
    .add("root_cause", "string")
    .add("confidence", "double")
    .add("reasoning", "string")
    .add("needs_review", "boolean")
)

ISSUES = (
    T.StructType()
    .add("framework_slug", "string", nullable=False)
    .add("issue_number", "long", nullable=False)
    .add("node_id", "string", nullable=False)
    .add("title", "string", nullable=False)
    .add("body", "string")
    .add("url", "string", nullable=False)
    .add("labels", _STRINGS)
    .add("state", "string", nullable=False)
    .add("is_pull_request", "boolean")
    .add("created_at", "timestamp")
    .add("updated_at", "timestamp")
    .add("closed_at", "timestamp")
    .add("comment_count", "long")
    .add("locus", "string", nullable=False)
    .add("phase", "string", nullable=False)
    .add("symptom", "string", nullable=False)
    .add("root_cause", "string", nullable=False)
    .add("confidence", "double")
    .add("reasoning", "string", nullable=False)
    .add("needs_review", "boolean")
    .add("classifier_tier", "string", nullable=False)
    .add("classifier_model", "string", nullable=False)
    .add("classifier_version", "string", nullable=False)
    .add("classified_at", "timestamp")
)

CROSS_LINKS = (
    T.StructType()
    .add("node_id", "string")
    .add("corpus_id", "string")
    .add("external_id", "string")
    .add("similarity", "double")
    .add("method", "string")
)

TAXONOMY = (
    T.StructType()
    .add("axis", "string")
    .add("label", "string")
    .add("definition", "string")
    .add("derived_from", _STRINGS)
)

FRAMEWORKS = (
    T.StructType()
    .add("slug", "string")
    .add("repo", "string")
    .add("display_name", "string")
    .add("homepage", "string")
)

RECORDS = (
    T.StructType()
    .add("corpus_id", "string")
    .add("external_id", "string")
    .add("title", "string")
    .add("text", "string")
)

CURSORS = (
    T.StructType()
    .add("slug", "string")
    .add("last_scraped_at", "timestamp")
)

RELABELS = (
    T.StructType()
    .add("node_id", "string")
    .add("framework_slug", "string")
    .add("locus", "string")
    .add("phase", "string")
    .add("symptom", "string")
    .add("root_cause", "string")
    .add("confidence", "double")
    .add("reasoning", "string")
    .add("needs_review", "boolean")
    .add("classifier_model", "string")
    .add("classified_at", "timestamp")
)

USAGE = (
    T.StructType()
    .add("node_id", "string")
    .add("prompt_tokens", "long")
    .add("completion_tokens", "long")
    .add("total_tokens", "long")
    .add("cache_hit_tokens", "long")
    .add("cache_miss_tokens", "long")
)

# What the model must return, as JSON, for one issue.
LABEL_RESPONSE = (
    T.StructType()
    .add("locus", "string")
    .add("phase", "string")
    .add("symptom", "string")
    .add("root_cause", "string")
    .add("confidence", "double")
    .add("reasoning", "string")
    .add("needs_review", "boolean")
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: its columns, its order, its types.

    A column the input lacks becomes a typed null.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, full schema."""
    return spark.createDataFrame([], schema)
