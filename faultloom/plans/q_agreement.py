"""Registered queries: agreement between annotators, exact-size samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultloom.operators import agreement, sampling
from faultloom.plans import views
from faultloom.plans.q_labels import long_sql
from faultloom.plans.registry import query
from faultloom.plans.views import ISSUES_SQL, second_labels, second_labels_sql, with_views
from faultloom.schemas import AXES
from faultloom.session import scratch_path

_A = "ann_a AS (SELECT node_id, locus, phase, symptom, root_cause FROM v_issues)"
_B = second_labels_sql("ann_b", 5)
_C = second_labels_sql("ann_c", 7)
_ANNOTATORS_SQL = with_views(ISSUES_SQL, _A, _B, _C)
_RATES = ("agreement_rate", "kappa")


def _annotators(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    return issues.select("node_id", *AXES), second_labels(issues, 5), second_labels(issues, 7)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _kappa_sql(pairs: str, by: str) -> str:
    """Kappa from a CTE ``pairs`` of (by..., a, b), with margins by label."""
    return f"""
    n AS (SELECT {by}, count(*) AS n, count(*) FILTER (WHERE a IS NOT DISTINCT FROM b) AS agreed
          FROM {pairs} GROUP BY ALL),
    ra AS (SELECT {by}, a AS label, count(*) AS k FROM {pairs} GROUP BY ALL),
    rb AS (SELECT {by}, b AS label, count(*) AS k FROM {pairs} GROUP BY ALL),
    pe AS (SELECT {by}, sum(CAST(ra.k AS DOUBLE) * rb.k) AS s FROM ra JOIN rb USING ({by}, label) GROUP BY ALL),
    kappas AS (SELECT {by}, n, agreed AS agreement_count, agreed / n AS agreement_rate,
                      CASE WHEN s / n / n < 1 THEN (agreed / n - s / n / n) / (1 - s / n / n) END AS kappa
               FROM n LEFT JOIN pe USING ({by}))"""


def _pairs_sql(first: str, second: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{axis}' AS axis, x.{axis} AS a, y.{axis} AS b"
        f" FROM {first} x JOIN {second} y USING (node_id)"
        for axis in AXES
    )


@query(
    "kappa_report",
    f"""WITH pairs AS (
      SELECT 'quality' AS axis, CAST(l.quality AS VARCHAR) AS a,
             CASE WHEN d.n_chars > 1000 THEN '1' ELSE '0' END AS b
      FROM labels l JOIN documents d USING (doc_id)),
    {_kappa_sql("pairs", "axis")}
    SELECT axis, n, agreement_count, round(agreement_rate, 6) AS agreement_rate, round(kappa, 6) AS kappa,
           printf('κ=%.3f, agreement=%d/%d', kappa, agreement_count, n) AS summary
    FROM kappas""",
)
def kappa_report(spark, sf_dir):
    """Annotated quality against a length rule, the one real label pair in the tables."""
    annotated = views.table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality")
    )
    rule = views.table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") > 1000).cast("int").cast("string").alias("quality")
    )
    report = agreement.kappa_report(annotated, rule, ("quality",), "doc_id")
    return _rounded(report, *_RATES)


_REPORT_AB_SQL = f"""{_ANNOTATORS_SQL}, pairs AS ({_pairs_sql("ann_a", "ann_b")}),
    {_kappa_sql("pairs", "axis")}"""


@query(
    "kappa_axes",
    f"""{_REPORT_AB_SQL}
    SELECT axis, n, agreement_count, round(agreement_rate, 6) AS agreement_rate, round(kappa, 6) AS kappa
    FROM kappas""",
)
def kappa_axes(spark, sf_dir):
    a, b, _ = _annotators(spark, sf_dir)
    return _rounded(agreement.kappa_report(a, b), *_RATES).drop("summary")


@query(
    "mean_kappa",
    f"""{_REPORT_AB_SQL}
    SELECT max(n) AS n, count(*) AS n_axes, round(avg(kappa), 6) AS mean_kappa FROM kappas""",
)
def mean_kappa(spark, sf_dir):
    a, b, _ = _annotators(spark, sf_dir)
    return _rounded(agreement.mean_kappa(agreement.kappa_report(a, b)), "mean_kappa")


@query(
    "kappa_join",
    f"""WITH a AS (SELECT o_custkey, o_orderpriority AS label FROM orders),
    b AS (SELECT o_custkey, o_orderstatus AS label FROM orders)
    SELECT o_custkey, a.label AS label_0, b.label AS label_1, count(*) AS weight
    FROM a JOIN b USING (o_custkey) GROUP BY ALL""",
)
def kappa_join(spark, sf_dir):
    """The weighted join on a key that repeats on both sides: duplicates multiply."""
    orders = views.table(spark, sf_dir, "orders")
    a = orders.select("o_custkey", F.col("o_orderpriority").alias("label"))
    b = orders.select("o_custkey", F.col("o_orderstatus").alias("label"))
    return agreement.join_labels([a, b], ("label",), "o_custkey")


@query(
    "confusion_table",
    f"""{_ANNOTATORS_SQL}, pairs AS ({_pairs_sql("ann_a", "ann_b")})
    SELECT axis, a AS label_a, b AS label_b, count(*) AS n FROM pairs GROUP BY ALL""",
)
def confusion_table(spark, sf_dir):
    a, b, _ = _annotators(spark, sf_dir)
    return agreement.confusion_table(a, b)


_NAMED = ("ann_a", "ann_b", "ann_c")


@query(
    "pairwise_kappa",
    f"""{_ANNOTATORS_SQL},
    votes AS ({" UNION ALL ".join(f"SELECT '{name}' AS annotator, t.* FROM ({long_sql(name, 'node_id')}) t" for name in _NAMED)}),
    pairs AS (SELECT x.annotator AS annotator_a, y.annotator AS annotator_b, axis, x.label AS a, y.label AS b
              FROM votes x JOIN votes y USING (node_id, axis) WHERE x.annotator < y.annotator),
    {_kappa_sql("pairs", "annotator_a, annotator_b, axis")}
    SELECT annotator_a, annotator_b, axis, n, agreement_count,
           round(agreement_rate, 6) AS agreement_rate, round(kappa, 6) AS kappa FROM kappas""",
)
def pairwise_kappa(spark, sf_dir):
    tables = dict(zip(_NAMED, _annotators(spark, sf_dir), strict=True))
    return _rounded(agreement.pairwise_kappa(agreement.annotations(tables)), *_RATES)


_TRIPLES = " UNION ALL ".join(
    f"SELECT '{axis}' AS axis, a.{axis} AS a, b.{axis} AS b, c.{axis} AS c"
    " FROM ann_a a JOIN ann_b b USING (node_id) JOIN ann_c c USING (node_id)"
    for axis in AXES
)


@query(
    "consensus",
    f"""{_ANNOTATORS_SQL}, triples AS ({_TRIPLES})
    SELECT axis, count(*) AS n, count(*) FILTER (WHERE a = b) AS pair_agrees,
           count(*) FILTER (WHERE a = b AND b = c) AS third_confirms,
           round(count(*) FILTER (WHERE a = b) / count(*), 6) AS pair_rate,
           round(count(*) FILTER (WHERE a = b AND b = c) / count(*) FILTER (WHERE a = b), 6) AS confirm_rate,
           round(count(*) FILTER (WHERE a = b AND b = c) / count(*), 6) AS all_three_rate
    FROM triples GROUP BY axis""",
)
def consensus(spark, sf_dir):
    found = agreement.consensus(*_annotators(spark, sf_dir))
    return _rounded(found, "pair_rate", "confirm_rate", "all_three_rate")


@query(
    "drift_disagreements",
    f"""{_ANNOTATORS_SQL}, pairs AS ({
        " UNION ALL ".join(
            f"SELECT node_id, '{axis}' AS axis, x.{axis} AS stored, y.{axis} AS audit"
            f" FROM ann_a x JOIN ann_c y USING (node_id)"
            for axis in AXES
        )
    })
    SELECT node_id, axis, stored, audit, count(*) AS n FROM pairs WHERE stored <> audit GROUP BY ALL""",
)
def drift_disagreements(spark, sf_dir):
    stored, _, audit = _annotators(spark, sf_dir)
    return agreement.disagreements(stored, audit)


@query(
    "drift_summary",
    f"""{_ANNOTATORS_SQL}
    SELECT count(*) AS sample_size,
           round(avg(CAST({" AND ".join(f"x.{a} = y.{a}" for a in AXES)} AS INT)), 6) AS agreement
    FROM ann_a x JOIN ann_c y USING (node_id)""",
)
def drift_summary(spark, sf_dir):
    stored, _, audit = _annotators(spark, sf_dir)
    return _rounded(agreement.drift_summary(stored, audit), "agreement")


# --- samples -------------------------------------------------------------------


def _allocation_sql(sizes: str, n: int, share: str = "size") -> str:
    """Targets per stratum by removing and adding single units, one row per unit.

    ``sizes`` is a CTE with the columns g and size.
    """
    return f"""
    t0 AS (SELECT g, size, row_number() OVER (ORDER BY size DESC, g NULLS LAST) AS ord,
                  greatest(1, least(size, CAST(round_even({n} * {share} / sum({share}) OVER (), 0) AS BIGINT))) AS t
           FROM {sizes}),
    lowest AS (SELECT g, row_number() OVER (ORDER BY u DESC, ord) AS r
               FROM (SELECT g, ord, unnest(range(2, t + 1)) AS u FROM t0)),
    t1 AS (SELECT g, size, ord, t - count(l.r) AS t
           FROM t0 LEFT JOIN (SELECT g, r FROM lowest
                              WHERE r <= (SELECT greatest(sum(t) - {n}, 0) FROM t0)) l USING (g)
           GROUP BY g, size, ord, t),
    highest AS (SELECT g, row_number() OVER (ORDER BY u DESC, ord) AS r
                FROM (SELECT g, ord, unnest(range(1, size - t + 1)) AS u FROM t1)),
    targets AS (SELECT g, size, CAST(t + count(h.r) AS BIGINT) AS target
           FROM t1 LEFT JOIN (SELECT g, r FROM highest
                              WHERE r <= (SELECT greatest({n} - sum(t), 0) FROM t1)) h USING (g)
           GROUP BY g, size, t)"""


_ORDER_SIZES = "sizes AS (SELECT o_orderpriority || '/' || o_orderstatus AS g, count(*) AS size FROM orders GROUP BY 1)"


def _strata(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return orders.withColumn("g", F.concat("o_orderpriority", F.lit("/"), "o_orderstatus"))


@query(
    "stratified_allocation",
    f"""WITH {_ORDER_SIZES}, {_allocation_sql("sizes", 251)}
    SELECT g, size, target FROM targets""",
)
def stratified_allocation(spark, sf_dir):
    sizes = sampling.stratum_sizes(_strata(spark, sf_dir), "g")
    return sampling.allocate(sizes, 251, stratum="g")


@query(
    "stratified_sample",
    f"""WITH {_ORDER_SIZES}, {_allocation_sql("sizes", 251)},
    ranked AS (SELECT o_orderkey, o_orderpriority || '/' || o_orderstatus AS g,
                      row_number() OVER (PARTITION BY o_orderpriority || '/' || o_orderstatus
                                         ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS r
               FROM orders)
    SELECT o_orderkey, g FROM ranked JOIN targets USING (g) WHERE r <= target""",
)
def stratified_sample(spark, sf_dir):
    found = sampling.stratified_sample(_strata(spark, sf_dir), 251, stratum="g", key="o_orderkey")
    return found.select("o_orderkey", "g")


_LANG_SIZES = "sizes AS (SELECT lang AS g, count(*) AS size FROM documents GROUP BY 1)"


@query(
    "stratified_sample_skewed",
    f"""WITH {_LANG_SIZES}, {_allocation_sql("sizes", 97)},
    ranked AS (SELECT doc_id, lang AS g,
                      row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':7'), doc_id) AS r
               FROM documents)
    SELECT doc_id, g FROM ranked JOIN targets USING (g) WHERE r <= target""",
)
def stratified_sample_skewed(spark, sf_dir):
    documents = views.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("g"))
    return sampling.stratified_sample(documents, 97, stratum="g", key="doc_id", seed=7)


@query(
    "random_sample",
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 500""",
)
def random_sample(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.random_sample(orders, 500, key="o_orderkey")


_WEIGHTS_SQL = """
flagged AS (SELECT node_id, framework_slug || '|' || needs_review || '|' || (x.root_cause <> y.root_cause) AS g,
                   1 + 3 * CAST(needs_review AS INT) + 5 * CAST(x.root_cause <> y.root_cause AS INT) AS w
            FROM v_issues x JOIN ann_b y USING (node_id)),
sizes AS (SELECT g, count(*) AS size, sum(w) AS weight FROM flagged GROUP BY 1)"""


@query(
    "oversampled_sample",
    f"""{_ANNOTATORS_SQL}, {_WEIGHTS_SQL}, {_allocation_sql("sizes", 120, "weight")},
    ranked AS (SELECT node_id, g, row_number() OVER (PARTITION BY g ORDER BY md5(node_id || ':42'), node_id) AS r
               FROM flagged)
    SELECT node_id, g FROM ranked JOIN targets USING (g) WHERE r <= target""",
)
def oversampled_sample(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    other = second_labels(issues, 5).select("node_id", F.col("root_cause").alias("other"))
    flagged = issues.join(other, "node_id").select(
        "node_id",
        "framework_slug",
        "needs_review",
        (F.col("root_cause") != F.col("other")).alias("disputed"),
    )
    strata = ["framework_slug", "needs_review", "disputed"]
    weight = (
        1 + 3 * F.col("needs_review").cast("int") + 5 * F.col("disputed").cast("int")
    )
    found = sampling.oversampled(flagged, 120, weight=weight, strata=strata)
    return found.select("node_id", F.concat_ws("|", *[F.col(c).cast("string") for c in strata]).alias("g"))


@query(
    "kappa_json_roundtrip",
    f"""WITH pairs AS (
      SELECT 'quality' AS axis, CAST(l.quality AS VARCHAR) AS a,
             CASE WHEN d.n_chars > 1000 THEN '1' ELSE '0' END AS b
      FROM labels l JOIN documents d USING (doc_id)),
    {_kappa_sql("pairs", "axis")}
    SELECT axis, n, agreement_count, round(kappa, 6) AS kappa FROM kappas""",
)
def kappa_json_roundtrip(spark, sf_dir):
    """The report written as a JSON file and read again."""
    annotated = views.table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality")
    )
    rule = views.table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") > 1000).cast("int").cast("string").alias("quality")
    )
    path = scratch_path(spark, "kappa-json")
    agreement.report_json(agreement.kappa_report(annotated, rule, ("quality",), "doc_id")).write.text(path)
    back = spark.read.schema("axis string, n long, agreement_count long, kappa double").json(path)
    return back.withColumn("kappa", F.round("kappa", 6))
