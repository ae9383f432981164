"""Intake: which landed issues are worth labelling, and how far each source has been read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.dims import framework_slugs
from faultloom.functions import text as tx
from faultloom.schemas import STATES
from faultloom.session import materialize

# Title words, failure label fragments and other label fragments.
TITLE_HINTS = (
    "bug",
    "error",
    "fail",
    "crash",
    "broken",
    "exception",
    "traceback",
    "not working",
    "doesn't work",
    "hang",
    "freeze",
    "stuck",
    "loop",
    "infinite",
    "regression",
    "typeerror",
    "valueerror",
    "keyerror",
    "attributeerror",
    "runtimeerror",
)
FAILURE_LABELS = ("bug", "error", "crash", "broken", "regression", "defect")
OTHER_LABELS = (
    "enhancement",
    "feature",
    "feat:",
    "docs",
    "documentation",
    "question",
    "discussion",
    "rfc",
    "proposal",
)


@dataclass(frozen=True)
class FailureTerms:
    """The three term lists of the failure test."""

    title: Sequence[str] = TITLE_HINTS
    failure_labels: Sequence[str] = FAILURE_LABELS
    other_labels: Sequence[str] = OTHER_LABELS


def looks_like_failure(
    title: Column,
    labels: Column,
    is_pull_request: Column,
    terms: FailureTerms = FailureTerms(),
) -> Column:
    """The permissive failure test, first rule that applies.

    Pull requests go. Issues labelled only as something other than a failure
    go. A failure label, a hint word in the title, or no label at all keeps.
    """
    labels = F.coalesce(labels, F.array().cast("array<string>"))
    failure = tx.any_label_contains(labels, terms.failure_labels)
    other = tx.any_label_contains(labels, terms.other_labels)
    hinted = tx.contains_any(F.lower(tx.or_empty(title)), terms.title)
    return (
        F.when(is_pull_request, F.lit(False))
        .when(failure, F.lit(True))
        .when(other, F.lit(False))
        .otherwise(hinted | (F.size(labels) == 0))
    )


def keep_failures(issues: DataFrame, terms: FailureTerms = FailureTerms()) -> DataFrame:
    """Raw issues that look like failure reports."""
    return issues.filter(
        looks_like_failure(F.col("title"), F.col("labels"), F.col("is_pull_request"), terms)
    )


def since_cursor(issues: DataFrame, cursors: DataFrame) -> DataFrame:
    """Issues at or after their source's cursor; a source without cursor keeps all.

    The cursor table has a row per source by definition, so it is broadcast and
    the issues stay where they are.
    """
    marks = cursors.select(
        F.col("slug").alias("framework_slug"), F.col("last_scraped_at").alias("_cursor")
    )
    return (
        issues.join(F.broadcast(marks), "framework_slug", "left")
        .filter(F.col("_cursor").isNull() | (F.col("updated_at") >= F.col("_cursor")))
        .drop("_cursor")
    )


def latest_versions(issues: DataFrame) -> DataFrame:
    """The newest version of each issue, as landed files may hold several.

    Ranked within partitions before the shuffle; a hash settles equal times.
    """
    newest = Window.partitionBy("node_id").orderBy(
        F.desc_nulls_last("updated_at"), F.desc(F.xxhash64(*issues.columns))
    )
    return (
        issues.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def only_framework(
    issues: DataFrame, slug: str, known: Sequence[str] | None = None
) -> DataFrame:
    """Issues of one framework. An unknown slug is the caller's mistake."""
    known = framework_slugs() if known is None else known
    if slug not in known:
        raise ValueError(f"Unknown framework slug {slug!r}. Valid slugs: {sorted(known)}")
    return issues.filter(F.col("framework_slug") == slug)


def with_state(issues: DataFrame, state: str = "all") -> DataFrame:
    """Open issues, closed issues or all of them."""
    if state == "all":
        return issues
    if state not in STATES:
        raise ValueError(f"state must be one of {STATES} or 'all', not {state!r}")
    return issues.filter(F.col("state") == state)


def cap_per_framework(issues: DataFrame, cap: int | None, salts: int = 256) -> DataFrame:
    """The newest ``cap`` issues of each framework; 0 or None means no cap.

    Up to the optimizer's group-limit threshold Spark already cuts each
    partition to ``cap`` rows per framework before the shuffle. Beyond it a
    first ranking over (framework, salt) does that, so no framework, however
    large, is ranked in one task.
    """
    if not cap:
        return issues
    order = [F.desc_nulls_last("updated_at"), F.desc("issue_number"), F.col("node_id")]
    limit = int(issues.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    ranked = issues
    if cap > limit:
        salted = Window.partitionBy("framework_slug", "_salt").orderBy(*order)
        ranked = (
            ranked.withColumn("_salt", F.pmod(F.xxhash64("node_id"), F.lit(salts)))
            .withColumn("_rank", F.row_number().over(salted))
            .filter(F.col("_rank") <= cap)
            .drop("_salt")
        )
    within = Window.partitionBy("framework_slug").orderBy(*order)
    return (
        ranked.withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= cap)
        .drop("_rank")
    )


#: Slots that a span of time is cut into, and rows of a slot that is not cut further.
SLOTS, SLOT_ROWS = 4096, 50_000
_NO_TIME, _FIRST = -(1 << 60), 1 << 61


def _cap_keys(issues: DataFrame, first: Column | None) -> DataFrame:
    """What the order of a cap looks at: rows that come first are later than any time, rows without time earlier."""
    at = F.coalesce(F.unix_micros("updated_at"), F.lit(_NO_TIME))
    if first is not None:
        at = F.when(first, at + F.lit(_FIRST)).otherwise(at)
    return issues.select("framework_slug", at.alias("at"), "issue_number", "node_id")


def _with_span(keys: DataFrame, spans: DataFrame) -> DataFrame:
    """Keys within the span of their framework. Spans have a row per framework and are broadcast."""
    inside = (F.col("at") >= F.col("low")) & (F.col("at") < F.col("high"))
    same = keys["framework_slug"].eqNullSafe(spans["slug"])
    return keys.join(F.broadcast(spans), same & inside).drop("slug")


def _cut_spans(keys: DataFrame, cap: int) -> DataFrame:
    """(slug, low, high, need, n): for each framework with more rows than the cap, the slot where the cap falls.

    Rows are counted in slots of a framework's span of time; the slot that holds
    the last row wanted is the next span, until it has few rows or is an instant.
    ``need`` of its ``n`` rows are wanted. A handful of passes over the keys, at any size.
    """
    spans = keys.groupBy(F.col("framework_slug").alias("slug")).agg(
        F.min("at").alias("low"), (F.max("at") + 1).alias("high"), F.lit(cap).cast("long").alias("need"), F.count("*").alias("n")
    )
    spans = materialize(spans.filter(F.col("n") > cap), "cap-spans")
    done = spans.limit(0)
    while True:
        small = F.expr(f"n <= {SLOT_ROWS} OR high - low = 1")
        done, spans = done.unionByName(spans.filter(small)), spans.filter(~small)
        if not spans.take(1):
            return done
        wide = spans.drop("n").withColumn("width", F.expr(f"(high - low + {SLOTS - 1}) div {SLOTS}"))
        slot = F.expr("(at - low) div width").alias("slot")
        counted = _with_span(keys, wide).groupBy(
            F.col("framework_slug").alias("slug"), "low", "high", "width", "need", slot
        ).agg(F.count("*").alias("n"))
        newest_first = Window.partitionBy("slug").orderBy(F.desc("slot"))
        cut = counted.withColumn("newer", F.sum("n").over(newest_first) - F.col("n"))
        cut = cut.filter("newer < need AND newer + n >= need").selectExpr(
            "slug", "low + slot * width AS low", "least(high, low + (slot + 1) * width) AS high", "need - newer AS need", "n"
        )
        spans = materialize(cut, "cap-spans")


def cap_by_cutoff(issues: DataFrame, cap: int | None, first: Column | None = None, salts: int = 64) -> DataFrame:
    """The newest ``cap`` issues of each framework, found by a cut-off; 0 or None means no cap.

    Same rows as ``cap_per_framework``, and one plan for every cap: the place of the
    last row wanted is found on the keys, and all rows up to it are filtered where
    they lie; no row is shuffled. The cut-offs have a row per framework and are
    broadcast. Rows for which ``first`` holds come before all others. Rows alike in
    time, number and id stay or go together.
    """
    if not cap:
        return issues
    keys = _cap_keys(issues, first)
    place = [F.desc("at"), F.desc("issue_number"), F.asc("node_id")]
    few = _with_span(keys, _cut_spans(keys, cap)).withColumn("salt", F.pmod(F.xxhash64("node_id"), F.lit(salts)))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("framework_slug", "salt").orderBy(*place)))
    ranked = ranked.filter(F.col("rank") <= F.col("need"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("framework_slug").orderBy(*place)))
    cuts = ranked.filter(F.col("rank") == F.col("need")).select(
        F.col("framework_slug").alias("_slug"), F.col("at").alias("_at"),
        F.col("issue_number").alias("_number"), F.col("node_id").alias("_node"),
    )
    cuts = materialize(cuts, "cap-cuts")
    return _before_cuts(issues, cuts, first)


def _before_cuts(issues: DataFrame, cuts: DataFrame, first: Column | None) -> DataFrame:
    """Rows up to their framework's cut-off; a framework without one keeps all."""
    time = F.coalesce(F.unix_micros("updated_at"), F.lit(_NO_TIME))
    at = time if first is None else F.when(first, time + F.lit(_FIRST)).otherwise(time)
    number, node = F.col("issue_number"), F.col("node_id")
    same_time = (number > F.col("_number")) | ((number == F.col("_number")) & (node <= F.col("_node")))
    kept = F.col("_at").isNull() | (at > F.col("_at")) | ((at == F.col("_at")) & same_time)
    joined = issues.join(F.broadcast(cuts), issues["framework_slug"].eqNullSafe(cuts["_slug"]), "left")
    return joined.filter(kept).select(*[issues[c] for c in issues.columns])


def next_cursors(kept: DataFrame) -> DataFrame:
    """The newest update seen per framework, which is where the next run starts."""
    return kept.groupBy(F.col("framework_slug").alias("slug")).agg(
        F.max("updated_at").alias("last_scraped_at")
    )
