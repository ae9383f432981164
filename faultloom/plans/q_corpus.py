"""Registered queries: merging, snapshots, publishing, corpus statistics, curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom import dims
from faultloom.functions.time import revision_tag
from faultloom.operators import curation, merging, stats
from faultloom.plans import views
from faultloom.plans.evaluation import published_diff
from faultloom.plans.q_labels import _TAXONOMY_SQL, long_sql
from faultloom.plans.registry import flat, query, sql_in, sql_iso
from faultloom.plans.views import ISSUES_SQL, STREAM_SQL, with_views
from faultloom.schemas import AXES, CROSS_LINKS, ISSUES, empty
from faultloom.session import scratch_path
from faultloom.sources import snapshots, state

_WEEK_SQL = "strftime(classified_at, '%G-W%V')"


# --- merging -----------------------------------------------------------------


def _order_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as an existing table, and again as a newer run over all of them.

    In the newer run every third order has an id of its own and every seventh
    label is older than the one it meets; every tenth label has no time.
    """
    orders = views.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    same_id = key.cast("string")
    own_id = F.when(key % 3 == 1, F.concat(F.lit("N"), same_id)).otherwise(same_id)
    days = F.when(key % 7 == 0, F.lit(-30)).otherwise(F.lit(30))

    def side(name: str, node_id: Column, shift: Column) -> DataFrame:
        labelled = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(days=shift)
        return orders.select(
            node_id.alias("node_id"),
            F.when(key % 10 != 0, labelled).alias("classified_at"),
            F.col("o_orderdate").cast("timestamp").alias("updated_at"),
            F.col("o_orderpriority").alias("symptom"),
            F.lit(name).alias("side"),
        )

    return side("new", own_id, days), side("existing", same_id, F.lit(0))


_SIDES_SQL = """
sides AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS node_id,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END AS classified_at,
         o_orderpriority AS symptom, 'existing' AS side, 0 AS is_new FROM orders
  UNION ALL
  SELECT CASE WHEN o_orderkey % 3 = 1 THEN 'N' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate
              + CASE WHEN o_orderkey % 7 = 0 THEN INTERVAL (-30) DAY ELSE INTERVAL 30 DAY END END,
         o_orderpriority, 'new', 1 FROM orders)"""

_NEWEST_SQL = f"""WITH {_SIDES_SQL}
    SELECT node_id, {sql_iso("classified_at")} AS classified_at, symptom, side FROM sides
    QUALIFY row_number() OVER (PARTITION BY node_id
                               ORDER BY classified_at DESC NULLS LAST, is_new DESC) = 1"""


@query("cumulative_merge", _NEWEST_SQL)
def cumulative_merge(spark, sf_dir):
    return flat(merging.merge_latest(*_order_sides(spark, sf_dir)).drop("updated_at"))


@query("cumulative_merge_unique", _NEWEST_SQL)
def cumulative_merge_unique(spark, sf_dir):
    """The same merge where the existing side is known to have a row per issue."""
    new, existing = _order_sides(spark, sf_dir)
    return flat(merging.merge_latest(new, existing, existing_unique=True).drop("updated_at"))


@query(
    "sort_nulls_last",
    f"""WITH {_SIDES_SQL}
    SELECT node_id, side, {sql_iso("classified_at")} AS classified_at FROM sides""",
)
def sort_nulls_last(spark, sf_dir):
    new, existing = _order_sides(spark, sf_dir)
    ordered = existing.unionByName(new).orderBy(F.desc_nulls_last("classified_at"), "node_id")
    return flat(ordered.select("node_id", "side", "classified_at"))


# --- shards --------------------------------------------------------------------


def _write_shards(spark: SparkSession, sf_dir: str) -> str:
    """A shard tree: one snapshot of the same revision per group of frameworks."""
    root = scratch_path(spark, "shards")
    issues = views.issues(spark, sf_dir)
    for shard in range(3):
        part = issues.filter(F.substring("framework_slug", 4, 2).cast("int") % 3 == shard)
        target = f"{root}/shard-{shard}/snapshots"
        snapshots.write_snapshot(part, empty(spark, CROSS_LINKS), target, "2024-W05")
    return root


@query(
    "shard_union",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, framework_slug, md5(body) AS body, symptom, '2024-W05' AS revision FROM v_issues""",
)
def shard_union(spark, sf_dir):
    found = snapshots.read_shards(spark, _write_shards(spark, sf_dir))
    return flat(found.select("node_id", "framework_slug", "body", "symptom", "revision"))


def _revisioned(issues: DataFrame) -> DataFrame:
    """Issues by the week of their label, and a later revision that holds all of them."""
    rows = issues.withColumn("revision", revision_tag(F.col("classified_at")))
    return rows.unionByName(issues.withColumn("revision", F.lit("2024-W51")))


_REVISIONS_SQL = f"""
revs AS (SELECT *, {_WEEK_SQL} AS revision FROM v_issues
         UNION ALL SELECT *, '2024-W51' FROM v_issues)"""


@query(
    "shard_revision_check",
    f"""{with_views(ISSUES_SQL, _REVISIONS_SQL)}
    SELECT count(DISTINCT revision) AS revisions, count(*) AS n_rows,
           count(DISTINCT revision) = 1 AS consistent FROM revs""",
)
def shard_revision_check(spark, sf_dir):
    return merging.shard_revisions(_revisioned(views.issues(spark, sf_dir)))


@query(
    "latest_revision",
    f"""{with_views(ISSUES_SQL, _REVISIONS_SQL)}
    SELECT node_id, framework_slug, revision FROM revs
    WHERE revision = (SELECT max(revision) FROM revs)""",
)
def latest_revision(spark, sf_dir):
    found = curation.latest_revision(_revisioned(views.issues(spark, sf_dir)))
    return found.select("node_id", "framework_slug", "revision")


_SHARD_CURSORS_SQL = """
files AS (SELECT 'shard-' || (issue_number % 4) AS file_path, framework_slug AS slug,
                 max(updated_at) AS ts
          FROM v_stream WHERE framework_slug <> 'swarm' GROUP BY ALL),
base AS (SELECT framework_slug AS slug, min(updated_at) AS ts FROM v_stream GROUP BY ALL)"""


@query(
    "merge_cursors",
    f"""{with_views(STREAM_SQL, _SHARD_CURSORS_SQL)}
    SELECT slug, {sql_iso("ts")} AS last_scraped_at
    FROM (SELECT slug, ts, file_path FROM files UNION ALL SELECT slug, ts, '' FROM base)
    QUALIFY row_number() OVER (PARTITION BY slug ORDER BY file_path DESC) = 1""",
)
def merge_cursors(spark, sf_dir):
    stream = views.stream(spark, sf_dir)
    found = (
        stream.filter("framework_slug <> 'swarm'")
        .groupBy(
            F.concat(F.lit("shard-"), (F.col("issue_number") % 4).cast("string")).alias(
                "file_path"
            ),
            F.col("framework_slug").alias("slug"),
        )
        .agg(F.max("updated_at").alias("last_scraped_at"))
    )
    base = stream.groupBy(F.col("framework_slug").alias("slug")).agg(
        F.min("updated_at").alias("last_scraped_at")
    )
    return flat(state.merge_cursors(found, base))


# --- snapshots -----------------------------------------------------------------


@query(
    "snapshot_roundtrip",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, md5(body) AS body, array_to_string(labels, ',') AS labels, {", ".join(AXES)},
           {sql_iso("classified_at")} AS classified_at FROM v_issues""",
)
def snapshot_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "snapshots")
    issues = views.issues(spark, sf_dir)
    snapshots.write_snapshot(issues, empty(spark, CROSS_LINKS), root, "2024-W05")
    back = snapshots.read_revisions(spark, root)
    return flat(back.select("node_id", "body", "labels", *AXES, "classified_at"))


@query(
    "publish_roundtrip",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, CASE WHEN issue_number % 3 = 0 THEN 'loop' ELSE symptom END AS symptom FROM v_issues""",
)
def publish_roundtrip(spark, sf_dir):
    """Two weeks published one after the other: a third of the second's labels are newer."""
    root, corpus = scratch_path(spark, "snapshots"), scratch_path(spark, "corpus")
    weeks = ("2024-W05", "2024-W06")
    rows = views.issues(spark, sf_dir)
    days = F.when(F.col("issue_number") % 3 == 0, F.lit(7)).otherwise(F.lit(-7))
    for revision in weeks:
        snapshot = snapshots.write_snapshot(rows, empty(spark, CROSS_LINKS), root, revision)
        snapshots.publish(spark, snapshot, corpus, revision)
        # The second week is made of the first as it was written: the tables are joined once.
        written = spark.read.schema(ISSUES).parquet(snapshots.snapshot_table(root, weeks[0], "issues"))
        rows = written.withColumns(
            {
                "symptom": F.lit("loop"),
                "classified_at": F.col("classified_at") + F.make_dt_interval(days=days),
            }
        )
    main = snapshots.read_table(spark, snapshots.corpus_table(corpus, None, "issues"), "issues")
    return main.select("node_id", "symptom")


# --- statistics ------------------------------------------------------------------


@query(
    "label_distribution",
    f"""{with_views(ISSUES_SQL)}, long AS ({long_sql("v_issues")})
    SELECT axis, label, count(*) AS n FROM long GROUP BY ALL""",
)
def label_distribution(spark, sf_dir):
    return stats.label_distribution(views.issues(spark, sf_dir))


@query(
    "axis_share",
    f"""{with_views(ISSUES_SQL)}, long AS ({long_sql("v_issues")}),
    counts AS (SELECT axis, label, count(*) AS n FROM long GROUP BY ALL)
    SELECT axis, label, n, round(n / sum(n) OVER (PARTITION BY axis), 6) AS share FROM counts""",
)
def axis_share(spark, sf_dir):
    found = stats.axis_share(views.issues(spark, sf_dir))
    return found.withColumn("share", F.round("share", 6))


@query(
    "drift_audit",
    f"""{with_views(ISSUES_SQL)},
    sample AS (SELECT * FROM v_issues ORDER BY md5(node_id || ':42'), node_id LIMIT 50),
    long AS ({long_sql("sample", axes=("locus", "symptom"))}),
    totals AS (SELECT count(*) AS sample_size, avg(confidence) AS mean_confidence,
                      avg(CAST(needs_review AS INT)) AS needs_review_rate FROM sample)
    SELECT axis, label, count(*) AS n, sample_size, round(mean_confidence, 6) AS mean_confidence,
           round(needs_review_rate, 6) AS needs_review_rate FROM long, totals GROUP BY ALL""",
)
def drift_audit(spark, sf_dir):
    found = stats.drift_audit(views.issues(spark, sf_dir), 50)
    rates = ("mean_confidence", "needs_review_rate")
    return found.withColumns({c: F.round(c, 6) for c in rates})


@query(
    "growth_summary",
    f"""{with_views(ISSUES_SQL, _REVISIONS_SQL)}
    SELECT count(*) AS total_rows_across_revisions,
           count(*) FILTER (WHERE classified_at >= TIMESTAMP '2024-01-05 12:00:00') AS classified_since,
           count(DISTINCT node_id) AS distinct_issues FROM revs""",
)
def growth_summary(spark, sf_dir):
    since = F.lit("2024-01-05 12:00:00").cast("timestamp")
    return stats.growth(_revisioned(views.issues(spark, sf_dir)), since)


@query(
    "framework_counts",
    f"""{with_views(STREAM_SQL)}
    SELECT coalesce(framework_slug, 'Total') AS framework_slug, count(*) AS n_issues
    FROM v_stream GROUP BY ROLLUP (framework_slug)""",
)
def framework_counts(spark, sf_dir):
    return stats.framework_counts(views.stream(spark, sf_dir))


_PROFILE = ("mean_confidence", "median_confidence", "high_share", "low_share", "needs_review_share")


@query(
    "confidence_profile",
    f"""{with_views(ISSUES_SQL)}
    SELECT framework_slug, count(*) AS n_issues, round(avg(confidence), 6) AS mean_confidence,
           round(median(confidence), 6) AS median_confidence,
           round(avg(CAST(confidence >= 0.8 AS INT)), 6) AS high_share,
           round(avg(CAST(confidence < 0.5 AS INT)), 6) AS low_share,
           round(avg(CAST(needs_review AS INT)), 6) AS needs_review_share
    FROM v_issues GROUP BY 1""",
)
def confidence_profile(spark, sf_dir):
    found = stats.confidence_profile(views.issues(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in _PROFILE})


def _any_unknown_sql() -> str:
    return " OR ".join(f"{a} = 'unknown'" for a in AXES)


@query(
    "unknown_share",
    f"""{with_views(ISSUES_SQL)}
    SELECT count(*) AS n_issues, round(avg(CAST({_any_unknown_sql()} AS INT)), 6) AS any_unknown,
           {", ".join(f"round(avg(CAST({a} = 'unknown' AS INT)), 6) AS {a}_unknown" for a in AXES)}
    FROM v_issues""",
)
def unknown_share(spark, sf_dir):
    found = stats.unknown_share(views.issues(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in found.columns if c != "n_issues"})


@query(
    "provenance_filter",
    f"""{with_views(ISSUES_SQL, _TAXONOMY_SQL)}, long AS ({long_sql("v_issues", "node_id")})
    SELECT node_id, axis, label FROM long JOIN taxonomy USING (axis, label)
    WHERE list_contains(string_split(derived_from, ','), 'mast')""",
)
def provenance_filter(spark, sf_dir):
    return stats.from_corpus(views.issues(spark, sf_dir), "mast")


@query(
    "high_precision_subset",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, symptom, confidence FROM v_issues
    WHERE NOT needs_review AND symptom <> 'unknown' AND classifier_tier = 'dry_run'
      AND classified_at >= TIMESTAMP '2024-01-02 12:00:00' AND confidence >= 0.7""",
)
def high_precision_subset(spark, sf_dir):
    found = stats.subset(
        views.issues(spark, sf_dir),
        reviewed=True,
        known_symptom=True,
        tier="dry_run",
        since=F.lit("2024-01-02 12:00:00").cast("timestamp"),
        min_confidence=0.7,
    )
    return found.select("node_id", "symptom", "confidence")


# --- curation ----------------------------------------------------------------------


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slugs seen in the data, known or not, with the issues behind them."""
    seen = views.issues(spark, sf_dir).select(F.col("framework_slug").alias("slug")).unionByName(
        views.stream(spark, sf_dir).select(F.col("framework_slug").alias("slug"))
    )
    return seen.groupBy("slug").agg(F.count("*").alias("n_issues"))


def _candidates_sql(word: str) -> str:
    return f"""{with_views(ISSUES_SQL, STREAM_SQL)},
    seen AS (SELECT framework_slug AS slug FROM v_issues UNION ALL SELECT framework_slug FROM v_stream)
    SELECT slug, count(*) AS n_issues FROM seen
    WHERE slug {word} {sql_in(dims.framework_slugs())} GROUP BY 1"""


@query("new_framework_candidates", _candidates_sql("NOT IN"))
def new_framework_candidates(spark, sf_dir):
    return curation.new_candidates(_proposed(spark, sf_dir), dims.frameworks(spark))


@query("known_framework", _candidates_sql("IN"))
def known_framework(spark, sf_dir):
    return curation.already_listed(_proposed(spark, sf_dir), dims.frameworks(spark))


@query(
    "revision_diff",
    f"""{with_views(ISSUES_SQL, _TAXONOMY_SQL)},
    earlier AS (SELECT axis, label, definition FROM taxonomy),
    later AS (SELECT axis, label, CASE label WHEN 'loop' THEN 'Never ends.' ELSE definition END AS definition
              FROM taxonomy WHERE label <> 'memory'),
    a AS (SELECT node_id, framework_slug FROM v_issues),
    b AS (SELECT CASE WHEN issue_number % 5 = 0 THEN node_id || 'x' ELSE node_id END AS node_id,
                 CASE WHEN framework_slug = 'src4' THEN 'moved' ELSE framework_slug END AS framework_slug
          FROM v_issues)
    SELECT 'issues' AS what, 'added' AS change, count(*) AS n FROM (SELECT node_id FROM b EXCEPT SELECT node_id FROM a)
    UNION ALL SELECT 'issues', 'removed', count(*) FROM (SELECT node_id FROM a EXCEPT SELECT node_id FROM b)
    UNION ALL SELECT 'frameworks', 'added', count(*) FROM (SELECT framework_slug FROM b EXCEPT SELECT framework_slug FROM a)
    UNION ALL SELECT 'frameworks', 'removed', count(*) FROM (SELECT framework_slug FROM a EXCEPT SELECT framework_slug FROM b)
    UNION ALL SELECT 'taxonomy', 'added', count(*) FROM (FROM later EXCEPT FROM earlier)
    UNION ALL SELECT 'taxonomy', 'removed', count(*) FROM (FROM earlier EXCEPT FROM later)""",
)
def revision_diff(spark, sf_dir):
    old = views.issues(spark, sf_dir)
    node_id, slug = F.col("node_id"), F.col("framework_slug")
    new = old.withColumns(
        {
            "node_id": F.when(
                F.col("issue_number") % 5 == 0, F.concat(node_id, F.lit("x"))
            ).otherwise(node_id),
            "framework_slug": F.when(slug == "src4", F.lit("moved")).otherwise(slug),
        }
    )
    labels = dims.taxonomy(spark)
    # A later taxonomy that drops one label and rewords another.
    reworded = F.when(F.col("label") == "loop", F.lit("Never ends.")).otherwise(F.col("definition"))
    later = labels.filter("label <> 'memory'").withColumn("definition", reworded)
    return curation.revision_diff(old, new, labels, later)


@query(
    "revision_diff_digests",
    f"""{with_views(ISSUES_SQL, _TAXONOMY_SQL)},
    a AS (SELECT node_id, framework_slug FROM v_issues WHERE issue_number % 7 <> 0),
    b AS (SELECT node_id, CASE WHEN framework_slug = 'src4' THEN 'moved' ELSE framework_slug END AS framework_slug
          FROM v_issues WHERE issue_number % 5 <> 0)
    SELECT 'issues' AS what, 'added' AS change, count(*) AS n FROM (SELECT node_id FROM b EXCEPT SELECT node_id FROM a)
    UNION ALL SELECT 'issues', 'removed', count(*) FROM (SELECT node_id FROM a EXCEPT SELECT node_id FROM b)
    UNION ALL SELECT 'frameworks', 'added', count(*) FROM (SELECT framework_slug FROM b EXCEPT SELECT framework_slug FROM a)
    UNION ALL SELECT 'frameworks', 'removed', count(*) FROM (SELECT framework_slug FROM a EXCEPT SELECT framework_slug FROM b)
    UNION ALL SELECT 'taxonomy', 'added', 0 UNION ALL SELECT 'taxonomy', 'removed', 0""",
)
def revision_diff_digests(spark, sf_dir):
    """Two published revisions; buckets with equal digests are not read."""
    root, corpus = scratch_path(spark, "snapshots"), scratch_path(spark, "corpus")
    issues, slug = views.issues(spark, sf_dir), F.col("framework_slug")
    later = issues.withColumn("framework_slug", F.when(slug == "src4", F.lit("moved")).otherwise(slug))
    for revision, rows in (("r1", issues.filter("issue_number % 7 <> 0")), ("r2", later.filter("issue_number % 5 <> 0"))):
        snapshot = snapshots.write_snapshot(rows, empty(spark, CROSS_LINKS), root, revision)
        snapshots.publish(spark, snapshot, corpus, revision, cumulative=False, buckets=16)
    return published_diff(spark, corpus, "r1", "r2")
