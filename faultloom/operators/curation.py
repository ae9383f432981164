"""Curation: proposed frameworks and what changed between revisions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_candidates(proposed: DataFrame, known: DataFrame) -> DataFrame:
    """Proposed slugs that are not in the list yet. The list is small and always broadcast."""
    return proposed.join(F.broadcast(known.select("slug")), "slug", "left_anti")


def already_listed(proposed: DataFrame, known: DataFrame) -> DataFrame:
    """Proposed slugs that are in the list."""
    return proposed.join(F.broadcast(known.select("slug")), "slug", "left_semi")


def latest_revision(revisions: DataFrame) -> DataFrame:
    """Rows of the newest revision; tags sort as text.

    The newest tag is a one-row subquery, so where revisions are directories
    only that directory's files are read.
    """
    newest = revisions.agg(F.max("revision").alias("revision")).scalar()
    return revisions.filter(F.col("revision") == newest)


def revision_diff(
    old: DataFrame, new: DataFrame, old_labels: DataFrame, new_labels: DataFrame
) -> DataFrame:
    """What was added or removed between two revisions: (what, change, n).

    Issues are compared by id, frameworks by slug, taxonomy rows by axis, label
    and definition.
    """
    return diff({
        "issues": (old, new, ["node_id"]),
        "frameworks": (old, new, ["framework_slug"]),
        "taxonomy": (old_labels, new_labels, ["axis", "label", "definition"]),
    })


def diff(sides: Mapping[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """(what, change, n) of tables before and after, each compared by its keys."""
    parts = []
    for what, (before, after, keys) in sides.items():
        a, b = before.select(keys).distinct(), after.select(keys).distinct()
        for change, rows in (
            ("added", b.join(a, keys, "left_anti")),
            ("removed", a.join(b, keys, "left_anti")),
        ):
            parts.append(
                rows.agg(F.count("*").alias("n")).select(
                    F.lit(what).alias("what"), F.lit(change).alias("change"), "n"
                )
            )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
