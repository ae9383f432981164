"""Registered queries: match texts, n-grams, linking by text similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom.functions.text import WORD
from faultloom.operators import linking, rows
from faultloom.plans import views
from faultloom.plans.q_labels import sql_strip
from faultloom.plans.registry import query, sql_in
from faultloom.plans.views import ISSUES_SQL, with_views
from faultloom.sources.records import load_records, trace_records

# Function words of the tables' English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "in", "is", "it", "to", "by", "for", "with", "that", "this", "was", "are",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "en", "pour", "par", "que", "qui",
    "der", "die", "das", "und", "von", "mit", "el", "los", "las", "con",
)

_MATCH_SQL = f"""
match AS (SELECT node_id, framework_slug || ' ' || title || ' ' || {sql_strip("coalesce(body, '')")} AS text
          FROM v_issues)"""


def _tokens_sql(source: str, keys: str) -> str:
    """(keys, term) rows of every word and word pair of a text."""
    return f"""
words AS (SELECT {keys}, list_filter(regexp_extract_all(lower(text), '{WORD}'),
                                     lambda w: w NOT IN {sql_in(STOP_WORDS)}) AS w FROM {source}),
terms AS (SELECT {keys}, unnest(w) AS term FROM words
          UNION ALL
          SELECT {keys}, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
          FROM words)"""


@query("match_text", f"{with_views(ISSUES_SQL, _MATCH_SQL)} SELECT node_id, text FROM match")
def match_text(spark, sf_dir):
    return rows.match_texts(views.issues(spark, sf_dir))


@query(
    "record_text",
    f"""SELECT 'mast' AS corpus_id, (doc_id % 3) || '-' || source || '-' || doc_id AS external_id,
           'MAST trace: ' || source || ' on ' || lang AS title,
           {sql_strip("source || ' ' || lang || ' ' || CASE WHEN doc_id % 4 = 0 THEN '' ELSE '1.' || (doc_id % 5) || ' lost | step' END || ' ' || text")} AS text
    FROM documents""",
)
def record_text(spark, sf_dir):
    """Documents as traces with two annotations each, the first of several lines."""
    doc = F.col("doc_id")
    first = F.concat(F.lit("1."), (doc % 5).cast("string"), F.lit(" lost\nand more"))
    notes = F.array(
        F.struct(first.alias("failure mode")), F.struct(F.lit("step\n").alias("failure mode"))
    )
    traces = views.table(spark, sf_dir, "documents").select(
        (doc % 3).cast("string").alias("round"),
        F.col("source").alias("mas_name"),
        F.col("lang").alias("benchmark_name"),
        doc.cast("string").alias("trace_id"),
        F.col("text").alias("trace"),
        F.when(doc % 4 != 0, notes).alias("annotations"),
    )
    return trace_records(traces)


@query(
    "ngram_document_frequency",
    f"""WITH {_tokens_sql("documents", "doc_id")},
    tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
    df AS (SELECT term, count(*) AS df, sum(tf) AS occurrences FROM tf GROUP BY 1)
    SELECT df, count(*) AS n_terms, CAST(sum(occurrences) AS BIGINT) AS occurrences,
           CAST(sum(length(term)) AS BIGINT) AS n_chars FROM df GROUP BY df""",
)
def ngram_document_frequency(spark, sf_dir):
    """How many terms occur in 1, 2, 3, ... documents, over all whole texts."""
    documents = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    frequency = linking.document_frequency(documents, STOP_WORDS, "doc_id")
    return frequency.groupBy("df").agg(
        F.count("*").alias("n_terms"),
        F.sum("occurrences").alias("occurrences"),
        F.sum(F.length("term")).alias("n_chars"),
    )


_LINKS_SQL = f"""
{with_views(ISSUES_SQL, _MATCH_SQL)},
texts AS (SELECT node_id AS id, 'issue' AS side, text FROM match
          UNION ALL SELECT CAST(item_id AS VARCHAR), 'record', text FROM benchmark),
{_tokens_sql("texts", "id, side")},
tf AS (SELECT id, side, term, count(*) AS tf FROM terms GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
total AS (SELECT count(*) AS n FROM texts),
weights AS (SELECT id, side, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w
            FROM tf JOIN df USING (term), total WHERE df <= 0.9 * n),
norms AS (SELECT id, side, sqrt(sum(w * w)) AS norm FROM weights GROUP BY ALL),
units AS (SELECT id, side, term, w / norm AS w FROM weights JOIN norms USING (id, side)),
sims AS (SELECT i.id AS node_id, 'mast' AS corpus_id, r.id AS external_id, least(sum(i.w * r.w), 1.0) AS similarity
         FROM units i JOIN units r USING (term) WHERE i.side = 'issue' AND r.side = 'record' GROUP BY ALL)"""


def _links(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    """Issues against the benchmark items, which some documents quote."""
    records = views.table(spark, sf_dir, "benchmark").select(
        F.lit("mast").alias("corpus_id"),
        F.col("item_id").cast("string").alias("external_id"),
        F.lit(None).cast("string").alias("title"),
        "text",
    )
    return linking.link_issues(
        views.issues(spark, sf_dir), records, threshold=threshold, stop_words=STOP_WORDS
    )


@query(
    "tfidf_crosslink",
    f"""{_LINKS_SQL}
    SELECT node_id, corpus_id, external_id, round(similarity, 6) AS similarity, 'semantic' AS method
    FROM sims WHERE similarity >= 0.05""",
)
def tfidf_crosslink(spark, sf_dir):
    return _links(spark, sf_dir, 0.05).withColumn("similarity", F.round("similarity", 6))


_SHORT_SQL = _LINKS_SQL.replace(
    "'record', text FROM benchmark)",
    "'record', text FROM benchmark"
    " UNION ALL SELECT 's' || item_id, 'record', split_part(text, ' ', 1) FROM benchmark WHERE item_id < 3)",
)


@query(
    "tfidf_crosslink_short_records",
    f"""{_SHORT_SQL}
    SELECT node_id, external_id, round(similarity, 6) AS similarity FROM sims WHERE similarity >= 0.1""",
)
def tfidf_crosslink_short_records(spark, sf_dir):
    """The same with three records of one word beside the others."""
    items = views.table(spark, sf_dir, "benchmark")
    item = F.col("item_id").cast("string")
    short = items.filter("item_id < 3").select(
        F.concat(F.lit("s"), item).alias("external_id"), F.split_part("text", F.lit(" "), F.lit(1)).alias("text")
    )
    records = items.select(item.alias("external_id"), "text").union(short).select(
        F.lit("mast").alias("corpus_id"), "external_id", F.lit(None).cast("string").alias("title"), "text"
    )
    links = linking.link_issues(
        views.issues(spark, sf_dir), records, threshold=0.1, stop_words=STOP_WORDS
    )
    return links.select("node_id", "external_id", F.round("similarity", 6).alias("similarity"))


_STEPS = (0.05, 0.10, 0.15, 0.20, 0.50)


@query(
    "link_threshold_sweep",
    f"""{_LINKS_SQL},
    steps(threshold) AS (VALUES {", ".join(f"(CAST({t} AS DOUBLE))" for t in _STEPS)})
    SELECT threshold, count(node_id) AS n_links
    FROM steps LEFT JOIN sims ON similarity >= threshold GROUP BY 1""",
)
def link_threshold_sweep(spark, sf_dir):
    return linking.links_at(_links(spark, sf_dir, min(_STEPS)), _STEPS)


@query(
    "top_links",
    f"""{_LINKS_SQL}
    SELECT node_id, corpus_id, external_id, round(similarity, 6) AS similarity
    FROM sims WHERE similarity >= 0.1
    ORDER BY sims.similarity DESC, node_id, corpus_id, external_id LIMIT 10""",
)
def top_links(spark, sf_dir):
    top = linking.top_links(_links(spark, sf_dir, 0.1), 10)
    return top.select(
        "node_id", "corpus_id", "external_id", F.round("similarity", 6).alias("similarity")
    )


@query(
    "links_per_record",
    f"""{_LINKS_SQL}
    SELECT corpus_id, external_id, count(*) AS n_issues,
           count(DISTINCT framework_slug) AS n_frameworks, round(max(similarity), 6) AS best_similarity
    FROM sims JOIN v_issues USING (node_id) WHERE similarity >= 0.05 GROUP BY ALL""",
)
def links_per_record(spark, sf_dir):
    found = linking.links_per_record(_links(spark, sf_dir, 0.05), views.issues(spark, sf_dir))
    return found.withColumn("best_similarity", F.round("best_similarity", 6))


@query(
    "record_registry",
    """SELECT 'mast' AS corpus_id, CAST(item_id AS VARCHAR) AS external_id, md5(text) AS text_md5 FROM benchmark
    UNION ALL SELECT 'agent_error', 'd' || doc_id, md5(text) FROM documents""",
)
def record_registry(spark, sf_dir):
    """Loaders of two corpora, one that fails and one that no corpus has."""

    def from_table(corpus: str, table: str, key):
        def load(session):
            rows_ = views.table(session, sf_dir, table)
            return rows_.select(
                F.lit(corpus).alias("corpus_id"), key.alias("external_id"), F.lit("t").alias("title"), "text"
            )

        return load

    def missing(session):
        return session.read.json(f"{sf_dir}/no-such-file")

    loaders = {
        "mast": from_table("mast", "benchmark", F.col("item_id").cast("string")),
        "agent_error": from_table("agent_error", "documents", F.concat(F.lit("d"), F.col("doc_id").cast("string"))),
        "faults_agentic": missing,
        "unheard_of": missing,
    }
    return load_records(spark, loaders).select("corpus_id", "external_id", F.md5("text").alias("text_md5"))
