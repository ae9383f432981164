"""Quality rules: a threshold table compiled into one projection.

Counts are made by SQL expressions inside the row, so a table is filtered in one
scan without a shuffle, whatever a source's or a group's share of the rows. A
row's memory follows its own text only.

Null texts count as empty: no words, ``base_failed`` true, ``kept`` false. Null
ids and repeated rows pass through, a result row for each input row. Columns of
the input besides id and text are not looked at, so their names cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import SPACES, let, window_hashes, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was as with be by are this at from have not or an"
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es"
    " de la le et les des en un du une que est pour qui dans par plus pas au sur avec ce il"
    " el y los se del las con no una su para al lo como más o pero sus"
).split()


class Rule(NamedTuple):
    """``low <= 1000 * part / whole <= high``; None leaves an end open. No whole, no failure."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2_000, 14_000),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 150),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 40, None),
    Rule("repeated_line_ratio", "n_dup_lines", "n_lines", None, 400),
)


def _holds(rule: Rule) -> Column:
    part, whole = F.col(rule.part) * 1000, F.col(rule.whole)
    test = F.lit(True)
    if rule.low is not None:
        test = test & (part >= whole * rule.low)
    if rule.high is not None:
        test = test & (part <= whole * rule.high)
    return test


def _sql_holds(rule: Rule) -> str:
    tests = []
    if rule.low is not None:
        tests.append(f"{rule.part} * 1000 >= {rule.whole} * {rule.low}")
    if rule.high is not None:
        tests.append(f"{rule.part} * 1000 <= {rule.whole} * {rule.high}")
    return " AND ".join(tests) or "TRUE"


def _covered(found: Column) -> Column:
    """Words inside windows that occur twice, comparing the windows themselves."""
    starts = F.sequence(F.lit(1), F.size(found) - (WINDOW - 1))
    windows = F.transform(
        starts,
        lambda i: F.struct(F.array_join(F.slice(found, i, F.lit(WINDOW)), " ").alias("w"), i.alias("i")),
    )

    def repeated(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k)["w"] == x["w"], F.lit(False))
        return F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))

    positions = F.sort_array(F.transform(let(F.sort_array(windows), repeated), lambda x: x["i"]))
    return F.aggregate(
        positions,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their counts; the counts replace columns of the same names."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumns({"_body": body, "_words": words(F.col(text)), "_lines": lines})
    hashed = split.withColumns({"_windows": window_hashes(F.col("_words"), WINDOW)})
    found = F.col("_words")
    repeats = F.when(
        F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0)
    ).otherwise(_covered(found))
    counts = {
        "n_words": F.size(found),
        "word_chars": F.length(F.regexp_replace("_body", SPACES, "")),
        "n_symbols": F.length("_body") - F.length(F.translate("_body", SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_lines": F.size("_lines"),
        "n_repeat_words": repeats,
        "n_stop_words": F.size(F.filter(found, lambda w: F.lower(w).isin(STOP_WORDS))),
    }
    counted = hashed.withColumns({k: v.cast("long") for k, v in counts.items()})
    return counted.drop("_body", "_words", "_lines", "_windows")


def judge(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``base_failed``, the names of the rules broken, and ``kept``."""
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    broken = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(r.name)) for r in rules]))
    return measured.withColumns({"base_failed": base, "broken_rules": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)
    )


def quality(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    only = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    return judge(measure(only)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_stop_words", "base_failed", "kept",
    )


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    held = " AND ".join(f"({_sql_holds(r)})" for r in rules)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), s AS (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) >= {WINDOW}
), g AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM s
), f AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g
), c AS (
  SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), {WINDOW}) AS gap FROM f WHERE n > 1
), p AS (SELECT r, sum(least({WINDOW}, gap)) AS n_repeat_words FROM c GROUP BY r
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, len(ls)::BIGINT AS n_lines,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words
  FROM w LEFT JOIN p USING (r)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words,
  base_failed, NOT base_failed AND {held} AS kept FROM b"""
