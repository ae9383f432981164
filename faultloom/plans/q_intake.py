"""Registered queries: payloads, failure test, cursors, caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.operators import intake
from faultloom.plans import views
from faultloom.plans.registry import flat, query, sql_iso
from faultloom.plans.views import GOOD_PAYLOAD_SQL, ISSUES_SQL, STREAM_SQL, with_views
from faultloom.plans.weekly import leave, take_turn
from faultloom.session import scratch_path
from faultloom.sources import fs, payloads, state

_RAW_SQL = f"""
framework_slug, issue_number, node_id, title, md5(body) AS body, url,
array_to_string(labels, ',') AS labels, state, author_association, is_pull_request,
{sql_iso("created_at")} AS created_at, {sql_iso("updated_at")} AS updated_at,
{sql_iso("closed_at")} AS closed_at, comment_count"""

# Words of the documents' invented language, as no usual hint word occurs in them.
DOCUMENT_TERMS = intake.FailureTerms(
    title=("ouble", "shble", "eaux"),
    failure_labels=("error", "purch"),
    other_labels=("signup", "fr"),
)


def _any(value: str, terms) -> str:
    return "(" + " OR ".join(f"contains({value}, '{t.replace(chr(39), chr(39) * 2)}')" for t in terms) + ")"


def failure_sql(terms: intake.FailureTerms = intake.FailureTerms()) -> str:
    """The failure test as a SQL condition, in the order the rules are documented."""

    def labelled(list_of_terms) -> str:
        return f"len(list_filter(labels, lambda x: {_any('lower(x)', list_of_terms)})) > 0"

    return f"""CASE WHEN is_pull_request THEN FALSE
      WHEN len(labels) > 0 AND {labelled(terms.other_labels)} AND NOT {labelled(terms.failure_labels)} THEN FALSE
      WHEN {labelled(terms.failure_labels)} THEN TRUE
      WHEN {_any("lower(coalesce(title, ''))", terms.title)} THEN TRUE
      ELSE len(labels) = 0 END"""


def land(spark: SparkSession, raw: DataFrame, tag: str) -> str:
    """Write raw issues as landed JSON lines into a fresh folder."""
    path = scratch_path(spark, tag)
    views.payload_text(raw).repartition(4).write.text(path)
    return path


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = land(spark, views.stream(spark, sf_dir), "landing")
    return payloads.type_payloads(payloads.read_landing(spark, landing))


@query(
    "flatten_payload",
    f"{with_views(STREAM_SQL)} SELECT {_RAW_SQL} FROM v_stream WHERE {GOOD_PAYLOAD_SQL}",
)
def flatten_payload(spark, sf_dir):
    return flat(payloads.good_rows(_typed(spark, sf_dir)))


@query(
    "payload_quarantine",
    f"""{with_views(STREAM_SQL)}
    SELECT CASE WHEN issue_number % 101 = 0 THEN 'malformed JSON'
                WHEN issue_number % 89 = 0 THEN 'missing title' ELSE 'bad created_at' END AS problem,
           count(*) AS n
    FROM v_stream WHERE NOT ({GOOD_PAYLOAD_SQL}) GROUP BY 1""",
)
def payload_quarantine(spark, sf_dir):
    bad = payloads.quarantine(_typed(spark, sf_dir))
    return bad.groupBy("problem").agg(F.count("*").alias("n"))


@query(
    "prefilter_events",
    f"""{with_views(STREAM_SQL)}
    SELECT node_id, framework_slug, title, array_to_string(labels, ',') AS labels
    FROM v_stream WHERE {failure_sql()}""",
)
def prefilter_events(spark, sf_dir):
    kept = intake.keep_failures(views.stream(spark, sf_dir))
    return flat(kept.select("node_id", "framework_slug", "title", "labels"))


@query(
    "prefilter_documents",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, title, array_to_string(labels, ',') AS labels
    FROM v_issues WHERE {failure_sql(DOCUMENT_TERMS)}""",
)
def prefilter_documents(spark, sf_dir):
    kept = intake.keep_failures(views.issues(spark, sf_dir), DOCUMENT_TERMS)
    return flat(kept.select("node_id", "title", "labels"))


_CURSORS_SQL = """
v_cursors AS (
  SELECT framework_slug AS slug,
         CASE WHEN framework_slug < 'm' THEN min(updated_at) + INTERVAL 10 DAY END AS last_scraped_at
  FROM v_stream GROUP BY 1
)"""


def _cursors(stream: DataFrame) -> DataFrame:
    """Ten days after each framework's first update; the later slugs have no time yet."""
    first = F.min("updated_at") + F.make_dt_interval(days=F.lit(10))
    return stream.groupBy(F.col("framework_slug").alias("slug")).agg(
        F.when(F.col("slug") < "m", first).alias("last_scraped_at")
    )


@query(
    "incremental_since",
    f"""{with_views(STREAM_SQL, _CURSORS_SQL)}
    SELECT node_id, framework_slug, {sql_iso("updated_at")} AS updated_at
    FROM v_stream LEFT JOIN v_cursors ON slug = framework_slug
    WHERE last_scraped_at IS NULL OR updated_at >= last_scraped_at""",
)
def incremental_since(spark, sf_dir):
    stream = views.stream(spark, sf_dir)
    new = intake.since_cursor(stream, _cursors(stream))
    return flat(new.select("node_id", "framework_slug", "updated_at"))


@query(
    "only_framework",
    f"""{with_views(STREAM_SQL)}
    SELECT node_id, issue_number, title FROM v_stream WHERE framework_slug = 'langgraph'""",
)
def only_framework(spark, sf_dir):
    found = intake.only_framework(views.stream(spark, sf_dir), "langgraph")
    return found.select("node_id", "issue_number", "title")


@query(
    "state_filter",
    f"""{with_views(STREAM_SQL)}
    SELECT framework_slug, count(*) AS n_open FROM v_stream WHERE state = 'open' GROUP BY 1""",
)
def state_filter(spark, sf_dir):
    found = intake.with_state(views.stream(spark, sf_dir), "open")
    return found.groupBy("framework_slug").agg(F.count("*").alias("n_open"))


@query(
    "cap_per_framework",
    f"""{with_views(STREAM_SQL)}
    SELECT node_id, framework_slug, {sql_iso("updated_at")} AS updated_at FROM v_stream
    WHERE {failure_sql()}
    QUALIFY row_number() OVER (PARTITION BY framework_slug
                               ORDER BY updated_at DESC, issue_number DESC) <= 150""",
)
def cap_per_framework(spark, sf_dir):
    kept = intake.keep_failures(views.stream(spark, sf_dir))
    return flat(
        intake.cap_by_cutoff(kept, 150).select("node_id", "framework_slug", "updated_at")
    )


@query(
    "cap_per_framework_large",
    f"""{with_views(STREAM_SQL)}
    SELECT node_id, framework_slug FROM v_stream
    QUALIFY row_number() OVER (PARTITION BY framework_slug
                               ORDER BY updated_at DESC, issue_number DESC) <= 1500""",
)
def cap_per_framework_large(spark, sf_dir):
    capped = intake.cap_by_cutoff(views.stream(spark, sf_dir), 1500)
    return capped.select("node_id", "framework_slug")


@query(
    "next_cursor",
    f"""{with_views(STREAM_SQL)}
    SELECT framework_slug AS slug, {sql_iso("max(updated_at)")} AS last_scraped_at
    FROM v_stream WHERE {failure_sql()} GROUP BY 1""",
)
def next_cursor(spark, sf_dir):
    return flat(intake.next_cursors(intake.keep_failures(views.stream(spark, sf_dir))))


@query(
    "cursor_files_roundtrip",
    f"""{with_views(STREAM_SQL)}, halves AS (
      SELECT framework_slug AS slug, issue_number % 2 AS shard, max(updated_at) AS last FROM v_stream GROUP BY ALL)
    SELECT slug, {sql_iso("coalesce(max(last) FILTER (WHERE shard = 1), max(last))")} AS last_scraped_at
    FROM halves GROUP BY slug""",
)
def cursor_files_roundtrip(spark, sf_dir):
    """Two shards' cursors written as files, found again under their tree and merged; the later file wins."""
    root, stream = scratch_path(spark, "shards"), views.stream(spark, sf_dir)
    for shard in (0, 1):
        own = stream.filter(F.col("issue_number") % 2 == shard)
        state.write_state_file(intake.next_cursors(own), f"{root}/deep/er/shard-{shard}")
    return flat(state.merge_cursors(state.read_state_files(spark, root)))


@query(
    "capped_backlog",
    f"""{with_views(STREAM_SQL)}, newest AS (
      SELECT *, row_number() OVER (PARTITION BY framework_slug ORDER BY updated_at DESC NULLS LAST, issue_number DESC, node_id) AS r
      FROM v_stream WHERE {failure_sql()})
    SELECT framework_slug, least((r - 1) // 20, 2) + 1 AS run, count(*) AS n, min(node_id) AS first_id
    FROM newest GROUP BY ALL""",
)
def capped_backlog(spark, sf_dir):
    """What two capped runs take, the second from the backlog alone, and what still waits: together all failure reports."""
    stream, backlog, turns = views.stream(spark, sf_dir), scratch_path(spark, "backlog"), []
    for run, new in ((1, stream), (2, stream.limit(0))):
        wanted, kept = take_turn(spark, new, backlog, 20)
        leave(spark, wanted, kept, backlog)
        turns.append(kept.withColumn("run", F.lit(run).cast("long")))
    waiting = spark.read.schema(stream.schema).parquet(fs.current_version(spark, backlog))
    both = turns[0].unionByName(turns[1]).unionByName(waiting.withColumn("run", F.lit(3).cast("long")))
    return both.groupBy("framework_slug", "run").agg(
        F.count("*").alias("n"), F.min("node_id").alias("first_id")
    )
