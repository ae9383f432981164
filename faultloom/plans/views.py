"""The driver's tables as tables of the domain, in Spark and in SQL.

Integer arithmetic stands in for labels and flags, so both sides see the same
values. Every view covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.dims import FRAMEWORK_ROWS, framework_slugs
from faultloom.functions.text import first_line
from faultloom.plans.registry import sql_list
from faultloom.schemas import AXES, DOMAINS, ISSUES, RAW_ISSUE, conform

# How doc_id is spread over an axis' labels.
_STEPS = {"locus": 5, "phase": 3, "symptom": 5, "root_cause": 3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, index: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, (index % len(values)).cast("int"))


def _sql_pick(values, index: str) -> str:
    return f"{sql_list(values)}[(({index}) % {len(values)}) + 1]"


# --- issues: documents with the event of the same number ------------------


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One issue per document. Documents and events are both numbered from 0."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    doc, chars, ts = F.col("doc_id"), F.col("n_chars"), F.col("ts")
    updated = ts + F.make_dt_interval(secs=chars)
    closed = doc % 3 == 0
    confidence = (chars % 101).cast("double") / 100
    rows = (
        table(spark, sf_dir, "documents")
        .join(events, "doc_id", "left")
        .select(
            F.col("source").alias("framework_slug"),
            doc.alias("issue_number"),
            F.concat(F.lit("D_"), doc.cast("string")).alias("node_id"),
            first_line(F.col("text")).alias("title"),
            F.col("text").alias("body"),
            F.concat(
                F.lit("https://example.org/"), "source", F.lit("/issues/"), doc.cast("string")
            ).alias("url"),
            F.array("event_type", "lang").alias("labels"),
            F.when(closed, F.lit("closed")).otherwise(F.lit("open")).alias("state"),
            F.lit(False).alias("is_pull_request"),
            ts.alias("created_at"),
            updated.alias("updated_at"),
            F.when(closed, updated).alias("closed_at"),
            (doc % 7).alias("comment_count"),
            *[_pick(DOMAINS[a], doc * _STEPS[a] + chars).alias(a) for a in AXES],
            confidence.alias("confidence"),
            F.concat(F.lit("rule "), (doc % 10).cast("string")).alias("reasoning"),
            ((confidence < 0.6) != (doc % 13 == 0)).alias("needs_review"),
            F.lit("dry_run").alias("classifier_tier"),
            F.concat(F.lit("model-"), (doc % 3).cast("string")).alias("classifier_model"),
            F.lit("0.1.0").alias("classifier_version"),
            (updated + F.make_dt_interval(days=F.lit(1))).alias("classified_at"),
        )
    )
    return conform(rows, ISSUES)


ISSUES_SQL = f"""
v_issues AS (
  SELECT source AS framework_slug, doc_id AS issue_number, 'D_' || doc_id AS node_id,
         split_part(text, chr(10), 1) AS title, text AS body,
         'https://example.org/' || source || '/issues/' || doc_id AS url,
         [event_type, lang] AS labels,
         CASE WHEN doc_id % 3 = 0 THEN 'closed' ELSE 'open' END AS state,
         FALSE AS is_pull_request, ts AS created_at,
         ts + to_seconds(n_chars) AS updated_at,
         CASE WHEN doc_id % 3 = 0 THEN ts + to_seconds(n_chars) END AS closed_at,
         doc_id % 7 AS comment_count,
         {", ".join(f"{_sql_pick(DOMAINS[a], f'doc_id * {_STEPS[a]} + n_chars')} AS {a}" for a in AXES)},
         CAST(n_chars % 101 AS DOUBLE) / 100 AS confidence,
         'rule ' || (doc_id % 10) AS reasoning,
         (CAST(n_chars % 101 AS DOUBLE) / 100 < 0.6) <> (doc_id % 13 = 0) AS needs_review,
         'dry_run' AS classifier_tier, 'model-' || (doc_id % 3) AS classifier_model,
         '0.1.0' AS classifier_version,
         ts + to_seconds(n_chars) + INTERVAL 1 DAY AS classified_at
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id
)"""


def second_labels(first: DataFrame, every: int) -> DataFrame:
    """Another annotator: the next label of each axis on every n-th issue, else the same."""
    moved = F.col("issue_number") % every == 0
    nexts = {}
    for axis in AXES:
        values = DOMAINS[axis]
        options = F.array(*[F.lit(v) for v in values])
        following = F.get(
            options, (F.array_position(options, F.col(axis)) % len(values)).cast("int")
        )
        nexts[axis] = F.when(moved, following).otherwise(F.col(axis))
    return first.select("node_id", *[nexts[a].alias(a) for a in AXES])


def second_labels_sql(name: str, every: int) -> str:
    picks = ", ".join(
        f"CASE WHEN issue_number % {every} = 0 THEN {sql_list(DOMAINS[a])}"
        f"[(list_position({sql_list(DOMAINS[a])}, {a}) % {len(DOMAINS[a])}) + 1] ELSE {a} END AS {a}"
        for a in AXES
    )
    return f"{name} AS (SELECT node_id, {picks} FROM v_issues)"


# --- stream: events as raw issues of the twelve frameworks -----------------


def stream_columns() -> list[Column]:
    """Event columns to raw issue columns."""
    event, user = F.col("event_id"), F.col("user_id")
    repo = _pick([row[1] for row in FRAMEWORK_ROWS], user)
    labels = (
        F.when(event % 5 == 0, F.array().cast("array<string>"))
        .when(event % 5 == 1, F.array("event_type"))
        .when(event % 5 == 2, F.array(F.col("event_type"), F.lit("docs")))
        .when(
            event % 5 == 3,
            F.array(F.concat(F.lit("type:"), "event_type"), F.lit("priority:high")),
        )
        .otherwise(F.array(F.lit("priority:high")))
    )
    ts = F.col("ts").cast("timestamp")
    return [
        _pick(framework_slugs(), user).alias("framework_slug"),
        event.alias("issue_number"),
        F.concat(F.lit("E_"), event.cast("string")).alias("node_id"),
        F.concat("event_type", F.lit(" event "), event.cast("string")).alias("title"),
        F.col("props").alias("body"),
        F.concat(
            F.lit("https://github.com/"), repo, F.lit("/issues/"), event.cast("string")
        ).alias("url"),
        labels.alias("labels"),
        F.when(event % 3 == 0, F.lit("closed")).otherwise(F.lit("open")).alias("state"),
        F.when(event % 2 == 0, F.lit("MEMBER")).alias("author_association"),
        (event % 11 == 0).alias("is_pull_request"),
        ts.alias("created_at"),
        (ts + F.make_dt_interval(secs=event % 1000)).alias("updated_at"),
        F.when(event % 3 == 0, ts).alias("closed_at"),
        F.when(event % 7 == 0, F.lit(0)).otherwise(event % 50).cast("long").alias("comment_count"),
    ]


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(table(spark, sf_dir, "events").select(*stream_columns()), RAW_ISSUE)


_REPOS = [row[1] for row in FRAMEWORK_ROWS]
STREAM_SQL = f"""
v_stream AS (
  SELECT {_sql_pick(framework_slugs(), "user_id")} AS framework_slug, event_id AS issue_number,
         'E_' || event_id AS node_id, event_type || ' event ' || event_id AS title,
         props AS body,
         'https://github.com/' || {_sql_pick(_REPOS, "user_id")} || '/issues/' || event_id AS url,
         CASE event_id % 5 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [event_type]
              WHEN 2 THEN [event_type, 'docs'] WHEN 3 THEN ['type:' || event_type, 'priority:high']
              ELSE ['priority:high'] END AS labels,
         CASE WHEN event_id % 3 = 0 THEN 'closed' ELSE 'open' END AS state,
         CASE WHEN event_id % 2 = 0 THEN 'MEMBER' END AS author_association,
         event_id % 11 = 0 AS is_pull_request, ts AS created_at,
         ts + to_seconds(event_id % 1000) AS updated_at,
         CASE WHEN event_id % 3 = 0 THEN ts END AS closed_at,
         CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 50 END AS comment_count
  FROM events
)"""


def payload_text(raw: DataFrame) -> DataFrame:
    """Raw issues back as landed JSON lines, some of them broken in the known ways."""
    n = F.col("issue_number")

    def stamp(name: str) -> Column:
        return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    record = F.to_json(
        F.struct(
            n.alias("number"),
            "node_id",
            F.when(n % 89 != 0, F.col("title")).alias("title"),
            "body",
            F.col("url").alias("html_url"),
            F.transform("labels", lambda x: F.struct(x.alias("name"))).alias("labels"),
            "state",
            "author_association",
            F.when(n % 97 == 0, F.lit("not a date")).otherwise(stamp("created_at")).alias(
                "created_at"
            ),
            stamp("updated_at").alias("updated_at"),
            stamp("closed_at").alias("closed_at"),
            F.when(n % 7 != 0, F.col("comment_count")).alias("comments"),
            F.when(F.col("is_pull_request"), F.struct(F.col("url").alias("url"))).alias(
                "pull_request"
            ),
        )
    )
    broken = F.substring(record, 1, 40)
    return raw.select(F.when(n % 101 == 0, broken).otherwise(record).alias("value"))


# Which payloads of payload_text are good, by issue number.
GOOD_PAYLOAD_SQL = "issue_number % 101 <> 0 AND issue_number % 89 <> 0 AND issue_number % 97 <> 0"


def with_views(*parts: str) -> str:
    """The WITH clause of an oracle statement."""
    return "WITH " + ",".join(parts)
