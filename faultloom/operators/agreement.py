"""Agreement between annotators: joins, confusion tables, Cohen's kappa, consensus.

Label tables are joined by key after counting equal rows of each side. A key
that occurs many times on both sides then costs one weighted row per distinct
pair of label rows instead of one row per pair, with the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.schemas import AXES

WEIGHT = "weight"
NO_OVERLAP = "No overlapping keys between the label tables."


def join_labels(
    tables: Sequence[DataFrame], axes: Sequence[str] = AXES, join_on: str = "node_id"
) -> DataFrame:
    """Inner join of label tables: the key, ``<axis>_<i>`` per table, and a weight.

    The weight says how many joined rows the row stands for. Each table is dealt
    by the key once, for the count and for the join.
    """
    joined, weight = None, F.lit(1)
    for i, table in enumerate(tables):
        counted = table.repartition(join_on).groupBy(
            F.col(join_on), *[F.col(axis).alias(f"{axis}_{i}") for axis in axes]
        ).agg(F.count("*").alias(f"_n_{i}"))
        joined = counted if joined is None else joined.join(counted, join_on)
        weight = weight * F.col(f"_n_{i}")
    labels = [f"{axis}_{i}" for i in range(len(tables)) for axis in axes]
    return joined.select(join_on, *labels, weight.alias(WEIGHT))


def _long(joined: DataFrame, axes: Sequence[str], n: int, *keep: str) -> DataFrame:
    """One row per axis: ``axis``, ``label_0`` ... ``label_<n-1>``."""
    cells = [
        F.struct(
            F.lit(axis).alias("axis"),
            *[F.col(f"{axis}_{i}").cast("string").alias(f"label_{i}") for i in range(n)],
        )
        for axis in axes
    ]
    return joined.select(*keep, WEIGHT, F.inline(F.array(*cells)))


def confusion_table(
    primary: DataFrame,
    secondary: DataFrame,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
) -> DataFrame:
    """How often each pair of labels met: (axis, label_a, label_b, n)."""
    return _confusion(_long(join_labels([primary, secondary], axes, join_on), axes, 2), "axis")


def _confusion(pairs: DataFrame, *by: str) -> DataFrame:
    return pairs.groupBy(
        *by, F.col("label_0").alias("label_a"), F.col("label_1").alias("label_b")
    ).agg(F.sum(WEIGHT).alias("n"))


def kappa_from_confusion(confusion: DataFrame, *by: str) -> DataFrame:
    """Cohen's kappa, n and agreement of each group of confusion cells.

    A cell feeds the margins of its two labels, so one pass over the cells
    gives both margins and the diagonal. Where chance agreement is 1 the value
    is undefined and comes out null.
    """
    same = F.col("label_a").eqNullSafe(F.col("label_b"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("label_a").alias("label"),
            F.col("n").alias("in_a"),
            zero.alias("in_b"),
            F.when(same, F.col("n")).otherwise(zero).alias("agreed"),
        ),
        F.struct(
            F.col("label_b").alias("label"),
            zero.alias("in_a"),
            F.col("n").alias("in_b"),
            zero.alias("agreed"),
        ),
    )
    margins = (
        confusion.select(*by, F.inline(sides))
        .groupBy(*by, "label")
        .agg(
            F.sum("in_a").cast("double").alias("in_a"),
            F.sum("in_b").cast("double").alias("in_b"),
            F.sum("agreed").alias("agreed"),
        )
    )
    sums = margins.groupBy(*by).agg(
        F.sum("in_a").alias("_n"),
        F.sum("agreed").alias("agreement_count"),
        F.sum(F.col("in_a") * F.col("in_b")).alias("_chance"),
    )
    observed = F.col("agreement_count") / F.col("_n")
    # Dividing by n once per factor keeps chance at exactly 1 for a single shared label.
    expected = F.col("_chance") / F.col("_n") / F.col("_n")
    return sums.select(
        *by,
        F.col("_n").cast("long").alias("n"),
        F.col("agreement_count").cast("long").alias("agreement_count"),
        observed.alias("agreement_rate"),
        F.try_divide(observed - expected, 1 - expected).alias("kappa"),
    )


def _summary() -> Column:
    return F.concat(
        F.lit("κ="),
        F.coalesce(F.format_string("%.3f", F.col("kappa")), F.lit("nan")),
        F.format_string(", agreement=%d/%d", F.col("agreement_count"), F.col("n")),
    )


def kappa_report(
    primary: DataFrame,
    secondary: DataFrame,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
    *,
    require_overlap: bool = True,
) -> DataFrame:
    """One row per axis: n, agreement count and rate, kappa and a summary line.

    Tables that share no key raise an error when the report is computed, or
    give a report without rows if ``require_overlap`` is off.
    """
    confusion = confusion_table(primary, secondary, axes, join_on)
    report = kappa_from_confusion(confusion, "axis").withColumn("summary", _summary())
    if not require_overlap:
        return report
    asked = F.explode(F.array(*[F.lit(axis) for axis in axes])).alias("axis")
    wanted = primary.sparkSession.range(1).select(asked)
    # A left join against the asked-for axes keeps a row to raise from. The report has a row per
    # axis, so it is always broadcast.
    checked = F.when(F.col("n").isNull(), F.raise_error(F.lit(NO_OVERLAP))).otherwise(F.col("n"))
    return wanted.join(F.broadcast(report), "axis", "left").withColumn("n", checked.cast("long"))


def mean_kappa(report: DataFrame, undefined: str = "null") -> DataFrame:
    """Plain mean of the axes' kappas.

    An undefined kappa makes the mean null, or is left out with
    ``undefined="skip"``.
    """
    if undefined not in ("null", "skip"):
        raise ValueError(f"undefined must be 'null' or 'skip', not {undefined!r}")
    mean = F.avg("kappa")
    if undefined == "null":
        mean = F.when(F.count("kappa") == F.count("*"), mean)
    return report.agg(
        F.max("n").alias("n"), F.count("*").alias("n_axes"), mean.alias("mean_kappa")
    )


def report_json(report: DataFrame) -> DataFrame:
    """The report's rows as JSON text, for a file sink."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("value"))


def collect_report(report: DataFrame, undefined: str = "null") -> dict[str, Any]:
    """A report as one nested document. It has a row per axis, so collecting is safe."""
    rows = [row.asDict() for row in report.collect()]
    kappas = [row["kappa"] for row in rows]
    known = [k for k in kappas if k is not None]
    complete = known and (undefined == "skip" or len(known) == len(kappas))
    return {
        "n": max(row["n"] for row in rows),
        "axes": [row["axis"] for row in rows],
        "per_axis": {
            row["axis"]: {key: row[key] for key in ("kappa", "agreement_count", "agreement_rate")}
            for row in rows
        },
        "mean_kappa": sum(known) / len(known) if complete else None,
        "summary": {row["axis"]: row["summary"] for row in rows},
    }


def annotations(tables: Mapping[str, DataFrame], axes: Sequence[str] = AXES) -> DataFrame:
    """Several annotators' label tables as (annotator, node_id, axis, label)."""
    cells = [F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("label")) for axis in axes]
    parts = [
        df.select(F.lit(name).alias("annotator"), "node_id", F.inline(F.array(*cells)))
        for name, df in tables.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def pairwise_kappa(labels: DataFrame) -> DataFrame:
    """Kappa of every pair of annotators, per axis.

    Equal annotations are counted first. An (issue, axis) group then holds at
    most one entry per annotator and label, and its pairs are formed in place.
    Rows without an issue are left out, as in the joins of two tables.
    """
    counted = labels.filter(F.col("node_id").isNotNull()).groupBy("node_id", "axis", "annotator", "label").agg(
        F.count("*").alias("n")
    )
    grouped = counted.groupBy("node_id", "axis").agg(
        F.collect_list(F.struct("annotator", "label", "n")).alias("votes")
    )
    pairs = F.flatten(
        F.transform(
            "votes",
            lambda a: F.transform(
                F.filter("votes", lambda b: a["annotator"] < b["annotator"]),
                lambda b: F.struct(
                    a["annotator"].alias("annotator_a"),
                    b["annotator"].alias("annotator_b"),
                    a["label"].alias("label_0"),
                    b["label"].alias("label_1"),
                    (a["n"] * b["n"]).alias(WEIGHT),
                ),
            ),
        )
    )
    by = ("annotator_a", "annotator_b", "axis")
    confusion = _confusion(grouped.select("axis", F.inline(pairs)), *by)
    return kappa_from_confusion(confusion, *by)


def consensus(
    first: DataFrame,
    second: DataFrame,
    third: DataFrame,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
) -> DataFrame:
    """Per axis: how often two annotators agree, and how often the third confirms them."""
    long = _long(join_labels([first, second, third], axes, join_on), axes, 3)
    pair = F.col("label_0").eqNullSafe(F.col("label_1"))
    confirmed = pair & F.col("label_1").eqNullSafe(F.col("label_2"))

    def weight_if(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(WEIGHT)).otherwise(F.lit(0)))

    return (
        long.groupBy("axis")
        .agg(
            F.sum(WEIGHT).alias("n"),
            weight_if(pair).alias("pair_agrees"),
            weight_if(confirmed).alias("third_confirms"),
        )
        .select(
            "*",
            (F.col("pair_agrees") / F.col("n")).alias("pair_rate"),
            F.try_divide("third_confirms", "pair_agrees").alias("confirm_rate"),
            (F.col("third_confirms") / F.col("n")).alias("all_three_rate"),
        )
    )


def disagreements(
    stored: DataFrame,
    audit: DataFrame,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
) -> DataFrame:
    """Every (issue, axis) on which an audit disagrees with the stored label."""
    long = _long(join_labels([stored, audit], axes, join_on), axes, 2, join_on)
    return long.filter(~F.col("label_0").eqNullSafe(F.col("label_1"))).select(
        join_on,
        "axis",
        F.col("label_0").alias("stored"),
        F.col("label_1").alias("audit"),
        F.col(WEIGHT).alias("n"),
    )


def drift_summary(
    stored: DataFrame,
    audit: DataFrame,
    axes: Sequence[str] = AXES,
    join_on: str = "node_id",
) -> DataFrame:
    """Sample size of an audit and the share of issues that agree on all axes."""
    joined = join_labels([stored, audit], axes, join_on)
    agrees = F.lit(True)
    for axis in axes:
        agrees = agrees & F.col(f"{axis}_0").eqNullSafe(F.col(f"{axis}_1"))
    agreed = F.sum(F.when(agrees, F.col(WEIGHT)).otherwise(F.lit(0)))
    return joined.agg(
        F.coalesce(F.sum(WEIGHT), F.lit(0)).alias("sample_size"),
        F.coalesce(F.try_divide(agreed, F.sum(WEIGHT)), F.lit(0.0)).alias("agreement"),
    )
