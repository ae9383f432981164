"""Registered queries: whole weekly runs, one after the other."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.functions.time import iso
from faultloom.plans import views
from faultloom.plans.q_intake import failure_sql
from faultloom.plans.registry import query, sql_iso
from faultloom.plans.views import GOOD_PAYLOAD_SQL, STREAM_SQL, with_views
from faultloom.plans.weekly import Labelling, WeeklyRun, run_weekly
from faultloom.session import scratch_path
from faultloom.sources import dead_letters, snapshots, state

CLOCKS = ("2026-04-24T12:00:00Z", "2026-05-01T12:00:00Z", "2026-05-08T12:00:00Z")


def _folders(spark: SparkSession, **over) -> dict[str, str]:
    names = ("landing", "snapshots", "cursors", "corpus", "quarantine")
    return {name: scratch_path(spark, name) for name in names} | over


def _land_half(spark: SparkSession, sf_dir: str, landing: str, half: int) -> None:
    """The events before or after the middle of their span of time, as landed files."""
    rows, at = views.stream(spark, sf_dir), F.unix_micros("updated_at")
    low, high = rows.agg(F.min(at), F.max(at)).first()
    middle = low + (high - low) // 2
    own = rows.filter(at < middle if half == 1 else at >= middle)
    views.payload_text(own).repartition(4).write.mode("append").text(landing)


_HALVES_SQL = f"""
spans AS (SELECT epoch_us(min(updated_at)) AS lo, epoch_us(max(updated_at)) AS hi FROM v_stream),
good AS (
  SELECT node_id, framework_slug, issue_number, updated_at,
         CASE WHEN epoch_us(updated_at) < lo + (hi - lo) // 2 THEN 1 ELSE 2 END AS half
  FROM v_stream, spans WHERE {GOOD_PAYLOAD_SQL} AND {failure_sql()})"""


def _main(spark: SparkSession, corpus: str) -> DataFrame:
    return snapshots.read_table(spark, snapshots.corpus_table(corpus, None, "issues"), "issues")


_CAP = 150


@query(
    "weekly_two_runs",
    f"""{with_views(STREAM_SQL, _HALVES_SQL)},
    first AS (SELECT *, row_number() OVER (PARTITION BY framework_slug ORDER BY updated_at DESC, issue_number DESC) AS r
              FROM good WHERE half = 1),
    moved AS (SELECT framework_slug AS slug, max(updated_at) AS last FROM first WHERE r <= {_CAP} GROUP BY 1),
    wanted AS (
      SELECT g.*, coalesce(f.r > {_CAP}, FALSE) AS waits
      FROM good g LEFT JOIN first f USING (node_id) LEFT JOIN moved m ON m.slug = g.framework_slug
      WHERE f.r > {_CAP} OR m.last IS NULL OR g.updated_at >= m.last),
    second AS (SELECT * FROM wanted QUALIFY row_number() OVER (
      PARTITION BY framework_slug ORDER BY waits DESC, updated_at DESC, issue_number DESC) <= {_CAP})
    SELECT 'issue' AS kind, node_id AS name, CASE WHEN s.node_id IS NULL THEN '{CLOCKS[0]}' ELSE '{CLOCKS[1]}' END AS value
    FROM (SELECT node_id FROM first WHERE r <= {_CAP} UNION SELECT node_id FROM second) LEFT JOIN second s USING (node_id)
    UNION ALL
    SELECT 'cursor', framework_slug, {sql_iso("max(updated_at)")}
    FROM (SELECT framework_slug, updated_at FROM first WHERE r <= {_CAP} UNION ALL SELECT framework_slug, updated_at FROM second)
    GROUP BY framework_slug""",
)
def weekly_two_runs(spark, sf_dir):
    """Two capped runs: what the first left over comes first in the second; no cursor moves back."""
    where = _folders(spark, backlog=scratch_path(spark, "backlog"))
    for half in (1, 2):
        _land_half(spark, sf_dir, where["landing"], half)
        run_weekly(spark, WeeklyRun(**where, as_of=CLOCKS[half - 1], cap=_CAP, main_is_unique=half == 2))
    clock = F.date_format("classified_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    issues = _main(spark, where["corpus"]).select(F.lit("issue").alias("kind"), F.col("node_id").alias("name"), clock.alias("value"))
    cursors = state.load_cursors(spark, where["cursors"])
    return issues.unionByName(
        cursors.select(F.lit("cursor").alias("kind"), F.col("slug").alias("name"), iso(F.col("last_scraped_at")).alias("value"))
    )


@query(
    "weekly_incremental",
    f"""{with_views(STREAM_SQL, _HALVES_SQL)}
    SELECT node_id, framework_slug, CASE half WHEN 1 THEN '{CLOCKS[0]}' ELSE '{CLOCKS[1]}' END AS classified_at FROM good""",
)
def weekly_incremental(spark, sf_dir):
    """Two runs with an inbox: the second reads only the files that landed after the first."""
    where = _folders(spark, inbox=scratch_path(spark, "inbox"))
    for half in (1, 2):
        _land_half(spark, sf_dir, where["landing"], half)
        run_weekly(spark, WeeklyRun(**where, as_of=CLOCKS[half - 1]))
    clock = F.date_format("classified_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return _main(spark, where["corpus"]).select("node_id", "framework_slug", clock.alias("classified_at"))


def refusing_labeller(every: int):
    """A factory of labellers that refuse each issue whose number ``every`` divides."""

    def factory():
        def label(prompt: str) -> dict:
            if int(re.search(r"Issue #(\d+)", prompt)[1]) % every == 0:
                raise ValueError("refused")
            return {"locus": "agent", "phase": "action", "symptom": "crash", "root_cause": "api_misuse", "confidence": 0.9, "reasoning": "r"}

        return label

    return factory


@query(
    "quarantine_replay",
    f"""{with_views(STREAM_SQL, _HALVES_SQL)},
    fates AS (
      SELECT node_id, CASE
        WHEN half = 1 AND issue_number % 4 <> 0 THEN 'run 1'
        WHEN issue_number % 8 <> 0 THEN 'run 2'
        WHEN half = 2 AND issue_number % 16 <> 0 THEN 'run 3' ELSE 'spent' END AS fate FROM good)
    SELECT 'issue' AS kind, fate, count(*) AS n, min(node_id) AS first_id FROM fates GROUP BY ALL
    UNION ALL
    SELECT 'payload', CASE WHEN issue_number % 101 = 0 THEN 'malformed JSON' WHEN issue_number % 89 = 0 THEN 'missing title'
           ELSE 'bad created_at' END || ' after 2', count(*), NULL
    FROM v_stream WHERE NOT ({GOOD_PAYLOAD_SQL}) GROUP BY 2""",
)
def quarantine_replay(spark, sf_dir):
    """Three runs whose labellers refuse ever fewer issues; each refused row is tried twice at most."""
    where = _folders(spark, inbox=scratch_path(spark, "inbox"), dead_letters=scratch_path(spark, "dead"), max_attempts=2)
    for week, every in enumerate((4, 8, 16)):
        if week < 2:
            _land_half(spark, sf_dir, where["landing"], week + 1)
        how = Labelling(refusing_labeller(every), model=f"run {week + 1}", parallelism=8)
        run_weekly(spark, WeeklyRun(**where, as_of=CLOCKS[week], labelling=how))
    done = _main(spark, where["corpus"]).select("node_id", F.col("classifier_model").alias("fate"))
    dead = dead_letters.read(spark, where["dead_letters"], "issues")
    spent = F.when(F.col("attempts") == 2, F.lit("spent")).otherwise(F.lit("waiting"))
    issues = done.unionByName(dead.select("node_id", spent.alias("fate"))).groupBy("fate").agg(
        F.count("*").alias("n"), F.min("node_id").alias("first_id")
    )
    bad = dead_letters.read(spark, where["dead_letters"], "payloads")
    fate = F.concat("reason", F.lit(" after "), F.col("attempts").cast("string"))
    payloads = bad.groupBy(fate.alias("fate")).agg(F.count("*").alias("n")).withColumn("first_id", F.lit(None).cast("string"))
    return issues.withColumn("kind", F.lit("issue")).unionByName(payloads.withColumn("kind", F.lit("payload")))
