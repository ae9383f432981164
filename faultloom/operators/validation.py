"""Label checks against the closed domains, and how often models break them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.schemas import (
    AXES,
    CORPUS_IDS,
    DOMAINS,
    LABEL_RESPONSE,
    LINK_METHODS,
    REASONING_LIMIT,
    REVIEW_CONFIDENCE,
)

# What can be wrong with a label row.
LONG_REASONING = "reasoning_too_long"
MISSING = "missing_value"
CONFIDENCE_RANGE = "confidence_out_of_range"
WRONG_AXIS = "label_of_another_axis"
INVENTED = "invented_label"

_ALL_LABELS = sorted({label for labels in DOMAINS.values() for label in labels})


def _reasons(*tests: tuple[Column, str]) -> Column:
    found = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in tests])
    return F.array_distinct(F.array_compact(found))


def label_problems() -> Column:
    """The reasons a label row is rejected, an empty array on a good row."""
    tests = []
    for axis in AXES:
        outside = ~F.col(axis).isin(*DOMAINS[axis])
        elsewhere = F.col(axis).isin(*_ALL_LABELS)
        tests += [
            (F.col(axis).isNull(), MISSING),
            (outside & elsewhere, WRONG_AXIS),
            (outside & ~elsewhere, INVENTED),
        ]
    tests += [
        (F.col("confidence").isNull() | F.col("reasoning").isNull(), MISSING),
        (~F.col("confidence").between(0.0, 1.0) | F.isnan("confidence"), CONFIDENCE_RANGE),
        (F.length("reasoning") > REASONING_LIMIT, LONG_REASONING),
    ]
    return _reasons(*tests)


def check_labels(labels: DataFrame) -> DataFrame:
    """Label rows with ``problems`` and ``valid``; split on the latter."""
    return labels.withColumn("problems", label_problems()).withColumn(
        "valid", F.size("problems") == 0
    )


def check_links(links: DataFrame) -> DataFrame:
    """Link rows with the same two columns."""
    problems = _reasons(
        (F.col("node_id").isNull() | F.col("external_id").isNull(), MISSING),
        (F.col("corpus_id").isNull() | ~F.col("corpus_id").isin(*CORPUS_IDS), "unknown_corpus"),
        (F.col("method").isNull() | ~F.col("method").isin(*LINK_METHODS), "unknown_method"),
        (
            F.col("similarity").isNull() | ~F.col("similarity").between(0.0, 1.0),
            "similarity_out_of_range",
        ),
    )
    return links.withColumn("problems", problems).withColumn("valid", F.size("problems") == 0)


def check_axes(taxonomy: DataFrame) -> DataFrame:
    """Taxonomy rows with whether their axis and label are known."""
    known = F.lit(False)
    for axis, labels in DOMAINS.items():
        known = known | ((F.col("axis") == axis) & F.col("label").isin(*labels))
    return taxonomy.withColumn("valid", F.coalesce(known, F.lit(False)))


def parse_responses(responses: DataFrame, text: str = "response") -> DataFrame:
    """Model output as JSON text, typed. What does not parse becomes nulls.

    A missing ``needs_review`` means false.
    """
    parsed = responses.withColumn("_r", F.from_json(text, LABEL_RESPONSE))
    fields = [
        F.coalesce(F.col("_r.needs_review"), F.lit(False)).alias("needs_review")
        if field.name == "needs_review"
        else F.col(f"_r.{field.name}")
        for field in LABEL_RESPONSE
    ]
    return parsed.select(*[c for c in responses.columns if c != text], *fields)


def conformance(checked: DataFrame, model: str = "classifier_model") -> DataFrame:
    """Rows, rejected rows and rows per kind of problem, for every model.

    One pass: each row is counted once under the kind '' and once per problem.
    """
    kinds = F.explode(F.concat(F.array(F.lit("")), F.col("problems")))
    per_kind = (
        checked.select(model, "valid", kinds.alias("kind"))
        .groupBy(model, "kind")
        .agg(F.count("*").alias("n_kind"), F.count_if(~F.col("valid")).alias("n_bad"))
    )
    totals = per_kind.filter(F.col("kind") == "").select(
        model, F.col("n_kind").alias("n_rows"), F.col("n_bad").alias("n_rejected")
    )
    problems = per_kind.filter(F.col("kind") != "").select(model, "kind", F.col("n_kind").alias("n_problem"))
    return totals.join(problems, model, "left").select(
        model,
        "n_rows",
        "n_rejected",
        (F.col("n_rejected") / F.col("n_rows")).alias("rejection_rate"),
        F.coalesce("kind", F.lit("none")).alias("kind"),
        F.coalesce("n_problem", F.lit(0)).alias("n_problem"),
    )


def review_rule_violations(issues: DataFrame) -> DataFrame:
    """Rows below the review confidence that are not flagged for review."""
    return issues.filter((F.col("confidence") < REVIEW_CONFIDENCE) & ~F.col("needs_review"))
