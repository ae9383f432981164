"""Registered queries: dimensions, row shapes, prompts, label checks, labelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultloom import dims
from faultloom.functions.text import WHITESPACE
from faultloom.functions.time import revision_tag
from faultloom.operators import labelling, rows, stats, validation
from faultloom.plans import views
from faultloom.plans.registry import flat, query, sql_in, sql_iso, sql_list, sql_text
from faultloom.plans.views import ISSUES_SQL, STREAM_SQL, with_views
from faultloom.schemas import AXES, CORPUS_IDS, DOMAINS, LABELS, LINK_METHODS
from faultloom.session import materialize, scratch_path

_AXES_SQL = ", ".join(AXES)


def sql_strip(text: str) -> str:
    codes = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
    return f"trim({text}, {codes})"


def _values(name: str, columns: str, tuples) -> str:
    body = ", ".join("(" + ", ".join(sql_text(v) for v in row) + ")" for row in tuples)
    return f"{name}({columns}) AS (VALUES {body})"


def long_sql(source: str, keep: str = "", axes=AXES) -> str:
    """Axis columns as rows, as one UNION ALL."""
    head = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{a}' AS axis, {a} AS label FROM {source}" for a in axes
    )


# --- dimensions ------------------------------------------------------------

_TAXONOMY_SQL = _values(
    "taxonomy",
    "axis, label, definition, derived_from",
    [(r.axis, r.label, r.definition, ",".join(r.derived_from)) for r in dims.TAXONOMY_ROWS],
)


@query(
    "taxonomy_table",
    f"""{with_views(ISSUES_SQL, _TAXONOMY_SQL, f"used AS ({long_sql('v_issues')})")}
    SELECT axis, label, definition, derived_from, count(used.label) AS n_issues
    FROM taxonomy LEFT JOIN used USING (axis, label) GROUP BY ALL""",
)
def taxonomy_table(spark, sf_dir):
    used = stats.label_distribution(views.issues(spark, sf_dir))
    joined = dims.taxonomy(spark).join(used, ["axis", "label"], "left")
    return flat(joined.withColumn("n_issues", F.coalesce("n", F.lit(0))).drop("n"))


@query(
    "frameworks_table",
    f"""{with_views(STREAM_SQL, _values("frameworks", "slug, repo, display_name, homepage", dims.FRAMEWORK_ROWS))}
    SELECT slug, repo, display_name, homepage, count(node_id) AS n_issues
    FROM frameworks LEFT JOIN v_stream ON framework_slug = slug GROUP BY ALL""",
)
def frameworks_table(spark, sf_dir):
    counts = (
        views.stream(spark, sf_dir)
        .groupBy(F.col("framework_slug").alias("slug"))
        .agg(F.count("*").alias("n"))
    )
    joined = dims.frameworks(spark).join(counts, "slug", "left")
    return joined.withColumn("n_issues", F.coalesce("n", F.lit(0))).drop("n")


# --- row shapes --------------------------------------------------------------


@query(
    "revision_tag",
    "SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS revision FROM orders",
)
def revision(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", revision_tag(F.col("o_orderdate")).alias("revision"))


_ISSUE_COLUMNS_SQL = f"""
framework_slug, issue_number, node_id, title, md5(body) AS body, url,
array_to_string(labels, ',') AS labels, state, is_pull_request,
{sql_iso("created_at")} AS created_at, {sql_iso("updated_at")} AS updated_at,
{sql_iso("closed_at")} AS closed_at, comment_count"""


@query(
    "compose_issue_rows",
    f"""{with_views(ISSUES_SQL)}
    SELECT {_ISSUE_COLUMNS_SQL}, {_AXES_SQL}, confidence, reasoning, needs_review,
           'human' AS classifier_tier, 'panel' AS classifier_model, '0.1.0' AS classifier_version,
           '2026-05-01T00:00:00.000000Z' AS classified_at
    FROM v_issues""",
)
def compose_issue_rows(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    composed = rows.issue_rows(
        rows.raw_from_issues(issues),
        issues.select(*LABELS.names),
        tier="human",
        model="panel",
        classified_at=F.lit("2026-05-01").cast("timestamp"),
    )
    return flat(composed)


@query(
    "issue_to_raw",
    f"""{with_views(ISSUES_SQL)}
    SELECT {_ISSUE_COLUMNS_SQL.replace("array_to_string(labels, ',')", "CASE WHEN issue_number % 4 = 0 THEN '' ELSE array_to_string(labels, ',') END")},
           CAST(NULL AS VARCHAR) AS author_association
    FROM v_issues""",
)
def issue_to_raw(spark, sf_dir):
    issues = views.issues(spark, sf_dir).withColumn(
        "labels", F.when(F.col("issue_number") % 4 != 0, F.col("labels"))
    )
    return flat(rows.raw_from_issues(issues))


@query(
    "dry_run_labels",
    f"""{with_views(STREAM_SQL)}
    SELECT node_id, framework_slug, 'unknown' AS locus, 'unknown' AS phase, 'unknown' AS symptom,
           'unknown' AS root_cause, CAST(0 AS DOUBLE) AS confidence,
           '{rows.DRY_RUN_REASONING}' AS reasoning, TRUE AS needs_review,
           'dry_run' AS classifier_tier, 'dry-run' AS classifier_model
    FROM v_stream""",
)
def dry_run_labels(spark, sf_dir):
    issues = rows.dry_run_issues(views.stream(spark, sf_dir))
    return issues.select(
        "node_id", "framework_slug", *AXES, "confidence", "reasoning", "needs_review",
        "classifier_tier", "classifier_model",
    )


# --- prompts -----------------------------------------------------------------

_BODY_SQL = sql_strip("coalesce(body, '')")
_PROMPTS_SQL = f"""
prompts AS (
  SELECT node_id,
    'Framework: ' || framework_slug || chr(10) || 'Issue #' || issue_number || ' (' || state || ')' || chr(10)
    || 'Labels: ' || CASE WHEN len(labels) > 0 THEN array_to_string(labels, ', ') ELSE '(none)' END || chr(10)
    || 'URL: ' || url || chr(10) || chr(10) || 'Title: ' || title || chr(10) || chr(10) || 'Body:' || chr(10)
    || CASE WHEN b = '' THEN '(empty)'
            WHEN length(b) > 4000 THEN substring(b, 1, 4000) || chr(10) || chr(10) || '[truncated]'
            ELSE b END AS prompt
  FROM (SELECT *, {_BODY_SQL} AS b FROM v_issues)
)"""


@query("render_prompt", f"{with_views(ISSUES_SQL, _PROMPTS_SQL)} SELECT node_id, prompt FROM prompts")
def render_prompt(spark, sf_dir):
    return rows.prompts(views.issues(spark, sf_dir))


# The length and MD5 of the published prefix.
PREFIX_CHARS, PREFIX_DIGEST = 3767, "2dbceb49beb5b9bd881ce4eb3d191c4b"


@query(
    "prompt_with_taxonomy",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)}
    SELECT node_id, length(prompt) + {PREFIX_CHARS} AS n_chars,
           md5({sql_text(dims.system_prompt())} || prompt) AS prompt_digest,
           '{PREFIX_DIGEST}' AS prefix_digest
    FROM prompts""",
)
def prompt_with_taxonomy(spark, sf_dir):
    found = rows.prompts_with_taxonomy(views.issues(spark, sf_dir))
    whole = F.concat("system_prompt", "prompt")
    return found.select(
        "node_id",
        F.length(whole).cast("long").alias("n_chars"),
        F.md5(whole).alias("prompt_digest"),
        F.md5("system_prompt").alias("prefix_digest"),
    )


# --- label checks ------------------------------------------------------------


def _responses(issues):
    """Model answers as JSON: most complete, some without a flag, some cut short."""
    n = F.col("issue_number")
    answer = F.to_json(
        F.struct(
            *AXES,
            "confidence",
            "reasoning",
            F.when(n % 6 != 0, F.col("needs_review")).alias("needs_review"),
        )
    )
    cut = F.substring(answer, 1, 12)
    return issues.select("node_id", F.when(n % 17 == 0, cut).otherwise(answer).alias("response"))


def _nulls_on(condition: str, columns) -> str:
    return ", ".join(f"CASE WHEN NOT ({condition}) THEN {c} END AS {c}" for c in columns)


@query(
    "parse_label_json",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, {_nulls_on("issue_number % 17 = 0", [*AXES, "confidence", "reasoning"])},
           CASE WHEN issue_number % 17 = 0 OR issue_number % 6 = 0 THEN FALSE ELSE needs_review END AS needs_review
    FROM v_issues""",
)
def parse_label_json(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    stored = labelling.stored_responses(rows.prompts(issues), _responses(issues))
    return validation.parse_responses(stored)


def _faulty(issues):
    """Labels with every kind of problem, each on its own share of the issues."""
    n = F.col("issue_number")
    return issues.select(
        "node_id",
        "classifier_model",
        F.when(n % 11 == 0, F.lit("gremlin")).otherwise(F.col("locus")).alias("locus"),
        "phase",
        F.when(n % 19 != 0, F.col("symptom")).alias("symptom"),
        F.when(n % 7 == 0, F.lit("memory")).otherwise(F.col("root_cause")).alias("root_cause"),
        F.when(n % 13 == 0, F.lit(1.5)).otherwise(F.col("confidence")).alias("confidence"),
        F.when(n % 5 == 0, F.repeat("reasoning", 90)).otherwise(F.col("reasoning")).alias(
            "reasoning"
        ),
        "needs_review",
    )


_FAULTY_SQL = f"""
faulty AS (
  SELECT node_id, classifier_model,
         list_filter([
           CASE WHEN issue_number % 19 = 0 THEN '{validation.MISSING}' END,
           CASE WHEN issue_number % 11 = 0 THEN '{validation.INVENTED}' END,
           CASE WHEN issue_number % 7 = 0 THEN '{validation.WRONG_AXIS}' END,
           CASE WHEN issue_number % 13 = 0 THEN '{validation.CONFIDENCE_RANGE}' END,
           CASE WHEN issue_number % 5 = 0 AND length(repeat(reasoning, 90)) > 500
                THEN '{validation.LONG_REASONING}' END], lambda x: x IS NOT NULL) AS problems
  FROM v_issues
)"""


@query(
    "validate_labels",
    f"""{with_views(ISSUES_SQL, _FAULTY_SQL)}
    SELECT node_id, len(problems) = 0 AS valid,
           array_to_string(list_sort(problems), ',') AS problems FROM faulty""",
)
def validate_labels(spark, sf_dir):
    checked = validation.check_labels(_faulty(views.issues(spark, sf_dir)))
    return flat(checked.select("node_id", "valid", F.array_sort("problems").alias("problems")))


@query(
    "conformance_report",
    f"""{with_views(ISSUES_SQL, _FAULTY_SQL)},
    totals AS (SELECT classifier_model, count(*) AS n_rows,
                      count(*) FILTER (WHERE len(problems) > 0) AS n_rejected
               FROM faulty GROUP BY 1),
    kinds AS (SELECT classifier_model, unnest(problems) AS kind FROM faulty)
    SELECT t.classifier_model, n_rows, n_rejected, n_rejected / n_rows AS rejection_rate,
           coalesce(kind, 'none') AS kind, count(kind) AS n_problem
    FROM totals t LEFT JOIN kinds USING (classifier_model) GROUP BY ALL""",
)
def conformance_report(spark, sf_dir):
    return validation.conformance(validation.check_labels(_faulty(views.issues(spark, sf_dir))))


@query(
    "validate_links",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, corpus_id, corpus_id IN {sql_in(CORPUS_IDS)} AND method IN {sql_in(LINK_METHODS)}
           AND similarity BETWEEN 0 AND 1 AS valid
    FROM (SELECT node_id, similarity,
                 {sql_list([*CORPUS_IDS, "elsewhere"])}[(issue_number % 6) + 1] AS corpus_id,
                 {sql_list([*LINK_METHODS, "guess"])}[(issue_number % 4) + 1] AS method
          FROM (SELECT *, confidence * 1.2 AS similarity FROM v_issues))""",
)
def validate_links(spark, sf_dir):
    n = F.col("issue_number")
    links = views.issues(spark, sf_dir).select(
        "node_id",
        F.get(F.array(*map(F.lit, [*CORPUS_IDS, "elsewhere"])), (n % 6).cast("int")).alias(
            "corpus_id"
        ),
        n.cast("string").alias("external_id"),
        (F.col("confidence") * 1.2).alias("similarity"),
        F.get(F.array(*map(F.lit, [*LINK_METHODS, "guess"])), (n % 4).cast("int")).alias("method"),
    )
    return validation.check_links(links).select("node_id", "corpus_id", "valid")


@query(
    "review_rule_violations",
    f"""{with_views(ISSUES_SQL)}
    SELECT node_id, confidence FROM v_issues WHERE confidence < 0.6 AND NOT needs_review""",
)
def review_rule_violations(spark, sf_dir):
    found = validation.review_rule_violations(views.issues(spark, sf_dir))
    return found.select("node_id", "confidence")


# --- labelling ---------------------------------------------------------------


def length_labeller():
    """A labeller that answers by the prompt's length and refuses some prompts."""

    def label(prompt: str) -> dict:
        n = len(prompt)
        if n % 17 == 0:
            raise ValueError("no label for this one")
        return {
            **{axis: DOMAINS[axis][n % len(DOMAINS[axis])] for axis in AXES},
            "confidence": 1.5 if n % 19 == 0 else (n % 100) / 100,
            "reasoning": f"length {n}",
            "needs_review": n % 2 == 0,
            "prompt_tokens": n,
            "completion_tokens": 90,
            "total_tokens": n + 90,
            "cache_hit_tokens": n // 2,
            "cache_miss_tokens": n - n // 2,
        }

    return label


def _length_labels_sql(source: str) -> str:
    picks = ", ".join(
        f"{sql_list(DOMAINS[a])}[(length(prompt) % {len(DOMAINS[a])}) + 1] AS {a}" for a in AXES
    )
    return f"""
    SELECT node_id, {picks}, CAST(length(prompt) % 100 AS DOUBLE) / 100 AS confidence,
           'length ' || length(prompt) AS reasoning, length(prompt) % 2 = 0 AS needs_review
    FROM {source} WHERE length(prompt) % 17 <> 0 AND length(prompt) % 19 <> 0"""


@query(
    "labeller_batch",
    f"{with_views(ISSUES_SQL, _PROMPTS_SQL)} {_length_labels_sql('prompts')}",
)
def labeller_batch(spark, sf_dir):
    labelled = labelling.label_prompts(
        rows.prompts(views.issues(spark, sf_dir)), length_labeller, parallelism=8
    )
    return labelling.accepted(labelled)


@query(
    "labeller_rejects",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)}
    SELECT CASE WHEN length(prompt) % 17 = 0 THEN 'ValueError: no label for this one' END AS error,
           count(*) AS n
    FROM prompts WHERE length(prompt) % 17 = 0 OR length(prompt) % 19 = 0 GROUP BY 1""",
)
def labeller_rejects(spark, sf_dir):
    labelled = labelling.label_prompts(
        rows.prompts(views.issues(spark, sf_dir)), length_labeller, parallelism=8
    )
    return labelling.rejected(labelled).groupBy("error").agg(F.count("*").alias("n"))


def wrong_type_labeller():
    """The length rule with some fields of types that their columns do not take."""
    right = length_labeller()

    def label(prompt: str) -> dict:
        answer = right(prompt)
        if len(prompt) % 5 == 0:
            answer["confidence"] = str(answer["confidence"])
        elif len(prompt) % 7 == 0:
            answer["reasoning"] = {"text": answer["reasoning"]}
        elif len(prompt) % 11 == 0:
            answer["total_tokens"] = 0.5
        elif len(prompt) % 13 == 0:
            answer["needs_review"] = "false"
        return answer

    return label


@query(
    "labeller_wrong_types",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)},
    fates AS (SELECT CASE WHEN length(prompt) % 17 = 0 THEN 'ValueError: no label for this one'
        WHEN length(prompt) % 5 = 0 THEN 'TypeError: confidence: str instead of double'
        WHEN length(prompt) % 7 = 0 THEN 'TypeError: reasoning: dict instead of string'
        WHEN length(prompt) % 11 = 0 THEN 'TypeError: total_tokens: float instead of bigint'
        WHEN length(prompt) % 13 = 0 THEN 'TypeError: needs_review: str instead of boolean'
        WHEN length(prompt) % 19 = 0 THEN 'broken constraint' ELSE 'accepted' END AS fate FROM prompts)
    SELECT fate, count(*) AS n FROM fates GROUP BY fate""",
)
def labeller_wrong_types(spark, sf_dir):
    labelled = labelling.label_prompts(
        rows.prompts(views.issues(spark, sf_dir)), wrong_type_labeller, parallelism=8
    )
    labelled = materialize(labelled, "wrong-types")
    bad = labelling.rejected(labelled).select(F.coalesce("error", F.lit("broken constraint")).alias("fate"))
    good = labelling.accepted(labelled).select(F.lit("accepted").alias("fate"))
    return bad.union(good).groupBy("fate").agg(F.count("*").alias("n"))


def numbered_labeller(run: int):
    """A factory of the length rule's labellers that say in which run they were asked."""

    def factory():
        right = length_labeller()

        def label(prompt: str) -> dict:
            answer = right(prompt)
            return answer | {"reasoning": f"{answer['reasoning']} run {run}"}

        return label

    return factory


@query(
    "labeller_resumed",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)}, again AS ({_length_labels_sql("prompts")})
    SELECT a.* REPLACE (a.reasoning || CASE WHEN issue_number % 2 = 0 THEN ' run 1' ELSE ' run 2' END AS reasoning),
           CASE WHEN issue_number % 2 = 1 THEN length(p.prompt) END AS prompt_tokens
    FROM again a JOIN v_issues i USING (node_id) JOIN prompts p USING (node_id)""",
)
def labeller_resumed(spark, sf_dir):
    """A job that got half way, and the job after it: answers of the first are not asked for again."""
    issues, store = views.issues(spark, sf_dir), scratch_path(spark, "answers")
    half = rows.prompts(issues.filter("issue_number % 2 = 0"))
    for run, prompts in ((1, half), (2, rows.prompts(issues))):
        labelled = labelling.label_resumed(
            prompts, numbered_labeller(run), store, "length-rule", per_wave=4_000, parallelism=8, concurrent=4
        )
    labelled = materialize(labelled, "resumed")
    counts = labelled.select("node_id", "prompt_tokens")
    return labelling.accepted(labelled).join(counts, "node_id")


@query(
    "labeller_repeated_ids",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)},
    twice AS (SELECT * FROM prompts UNION ALL SELECT * FROM prompts),
    again AS ({_length_labels_sql("twice")})
    SELECT node_id, count(*) AS n, min(reasoning) AS reasoning FROM again GROUP BY node_id""",
)
def labeller_repeated_ids(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    labelled = labelling.label_prompts(
        rows.prompts_with_rows(rows.raw_from_issues(issues.union(issues))), length_labeller, parallelism=8
    )
    stamped = rows.stamped_rows(
        rows.with_labels(labelling.accepted_rows(labelled)), tier="v4_pro", model="length-rule"
    )
    return stamped.groupBy("node_id").agg(F.count("*").alias("n"), F.min("reasoning").alias("reasoning"))


@query(
    "relabel_projection",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)}, again AS ({_length_labels_sql("prompts")})
    SELECT node_id, framework_slug, a.locus, a.phase, a.symptom, a.root_cause, a.confidence,
           a.reasoning, a.needs_review, 'length-rule' AS classifier_model,
           '2026-05-02T00:00:00.000000Z' AS classified_at
    FROM again a JOIN (SELECT node_id, framework_slug FROM v_issues) USING (node_id)""",
)
def relabel_projection(spark, sf_dir):
    issues = views.issues(spark, sf_dir)
    labelled = labelling.label_prompts(
        rows.prompts_with_rows(rows.raw_from_issues(issues)), length_labeller, parallelism=8
    )
    found = rows.with_labels(labelling.accepted_rows(labelled))
    clock = F.lit("2026-05-02").cast("timestamp")
    return flat(rows.relabelled(found, "length-rule", clock))


# --- usage -------------------------------------------------------------------

# Published prices per million tokens (cached input, input) and one for output.
PRICES = (("model-0", 0.003625, 0.435, 0.87), ("model-1", 0.5, 5.0, 30.0))


@query(
    "usage_rollup",
    f"""{with_views(ISSUES_SQL)},
    usage AS (SELECT classifier_model, length(body) + 900 AS prompt_tokens, 90 AS completion_tokens,
                     CASE WHEN issue_number % 9 <> 0 THEN 900 ELSE 0 END AS hit
              FROM v_issues),
    prices(classifier_model, cached, uncached, output) AS
      (VALUES {", ".join(f"('{m}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))" for m, a, b, c in PRICES)}),
    sums AS (SELECT classifier_model, count(*) AS n_calls,
                    CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
                    CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
                    CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS total_tokens,
                    CAST(sum(hit) AS BIGINT) AS cache_hit_tokens,
                    CAST(sum(prompt_tokens - hit) AS BIGINT) AS cache_miss_tokens
             FROM usage GROUP BY 1)
    SELECT s.*, round(cache_hit_tokens / prompt_tokens, 6) AS cache_hit_ratio,
           round((cache_hit_tokens * cached + cache_miss_tokens * uncached + completion_tokens * output) / 1e6, 6) AS cost,
           round((cache_hit_tokens * cached + cache_miss_tokens * uncached + completion_tokens * output) / 1e6 / n_calls, 6) AS cost_per_call
    FROM sums s LEFT JOIN prices USING (classifier_model)""",
)
def usage_rollup(spark, sf_dir):
    tokens = F.length("body").cast("long") + 900
    hit = F.when(F.col("issue_number") % 9 != 0, F.lit(900)).otherwise(F.lit(0))
    usage = views.issues(spark, sf_dir).select(
        "classifier_model",
        tokens.alias("prompt_tokens"),
        F.lit(90).alias("completion_tokens"),
        (tokens + 90).alias("total_tokens"),
        hit.alias("cache_hit_tokens"),
        (tokens - hit).alias("cache_miss_tokens"),
    )
    prices = spark.createDataFrame(
        PRICES,
        "classifier_model string, cached_price double, uncached_price double, output_price double",
    )
    doubles = ("cache_hit_ratio", "cost", "cost_per_call")
    rolled = stats.usage_rollup(usage, prices)
    return rolled.withColumns({c: F.round(c, 6) for c in doubles})




@query(
    "usage_from_labelling",
    f"""{with_views(ISSUES_SQL, _PROMPTS_SQL)}
    SELECT count(*) AS n_calls, CAST(sum(length(prompt)) AS BIGINT) AS prompt_tokens,
           CAST(sum(length(prompt) + 90) AS BIGINT) AS total_tokens,
           CAST(sum(length(prompt) // 2) AS BIGINT) AS cache_hit_tokens
    FROM prompts WHERE length(prompt) % 17 <> 0""",
)
def usage_from_labelling(spark, sf_dir):
    """Token counts as the labelling job records them, one row per call that was answered."""
    labelled = labelling.label_prompts(
        rows.prompts(views.issues(spark, sf_dir)), length_labeller, parallelism=8
    )
    return labelling.usage(labelled).agg(
        F.count("*").alias("n_calls"),
        *[F.sum(c).alias(c) for c in ("prompt_tokens", "total_tokens", "cache_hit_tokens")],
    )
