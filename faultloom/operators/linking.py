"""Linking issues to outside records by TF-IDF cosine similarity, as a distributed join.

Every pair at or above the threshold is found; none below it is ever compared
in full. The steps:

1. Equal texts are collapsed to one text with two counts, how many issues and
   how many records carry it. A crowd of copies is tokenised and compared once.
   If the records' terms can be broadcast, issues that cannot reach the threshold
   go here. An issue's products with the records need the frequencies of the
   records' terms only; the frequency of any other term is at most that of all
   terms with the same hash, so it adds at least so much to the issue's norm, and
   the similarity is at most the products divided by that norm. The terms of all
   issues are never shuffled so; the steps below see the issues that are left.
2. Term and document frequencies come from grouped counts that are combined
   before the shuffle. Weights need one join of the terms with their frequency,
   in which the hot terms, few by definition, are broadcast.
3. Within a text, terms are ordered from rare to frequent. What a term and all
   after it can add to a similarity is at most the norm of that part of the
   issue times the largest norm any record has on terms that frequent. The
   issue's prefix ends where this product drops below the threshold, so a pair
   that shares no prefix term cannot reach it (prefix filtering after Bayardo,
   Ma, Srikant: Scaling Up All Pairs Similarity Search, WWW 2007). It goes on
   until the rest can add no more than a part of the threshold, so that a pair
   with one weak common term has no chance in the next step.
4. Prefix terms are joined with the records' terms and summed per pair. A pair
   survives if its sum plus what the issue's rest can add reaches the threshold.
   The rest is added for the survivors only.
5. Surviving pairs of texts are expanded to the issues and records behind them.

Frequent terms, which would make hot keys of the join, are the ones left
outside the prefixes. AQE splits what skew remains.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.functions import text as tx
from faultloom.operators.rows import match_texts
from faultloom.schemas import CROSS_LINKS, conform, empty
from faultloom.session import materialize

# The linking defaults.
THRESHOLD = 0.10
MAX_DOCUMENT_SHARE = 0.9

# Sums in another order may differ in the last digits; a bound must not lose a pair to that.
_SLACK = 1e-9

# The part of the threshold that terms after the prefix may add.
_REST = 0.25

# A term with more than 1/_HOT_TERMS of all (text, term) entries is hot. There are fewer than that.
_HOT_TERMS = 100_000
_SALTS = 1024

# The records' terms, one by one and per record, are broadcast up to so many rows.
_BROADCAST_TERMS = 100_000

# How many hashes bound the frequencies of the other terms, and the most words of 64 bits of a filter of terms.
_HASHES = 1 << 18
_FILTER_WORDS = 1 << 20

# Ids of texts, of 16 bytes, are broadcast up to so many.
_BROADCAST_IDS = 500_000


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


class _Texts(NamedTuple):
    issues: DataFrame  # node_id, text_id
    records: DataFrame  # corpus_id, external_id, text_id
    distinct: DataFrame  # text_id, text or words, n_issues, n_records


def _texts(issues: DataFrame, records: DataFrame) -> _Texts:
    """Collapse equal texts; 128 bits of a text's SHA-256 are its identity."""
    identity = F.unhex(F.substring(F.sha2("text", 256), 1, 32)).alias("text_id")
    left = issues.filter(F.col("text").isNotNull())
    right = records.filter(F.col("text").isNotNull())
    both = left.select(
        identity, "text", F.lit(1).alias("i"), F.lit(0).alias("r")
    ).unionByName(right.select(identity, "text", F.lit(0).alias("i"), F.lit(1).alias("r")))
    distinct = both.groupBy("text_id").agg(
        F.first("text").alias("text"),
        F.sum("i").alias("n_issues"),
        F.sum("r").alias("n_records"),
    )
    return _Texts(
        left.select("node_id", identity),
        right.select("corpus_id", "external_id", identity),
        distinct,
    )


def _tokenised(texts: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """The texts as ``words``."""
    return texts.withColumn("words", tx.words(F.col("text"), stop_words)).drop("text")


def _terms(texts: DataFrame, stop_words: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` columns and ``terms``, the words and word pairs of each text or of its ``words``, if these are made."""
    words = texts if "words" in texts.columns else _tokenised(texts, stop_words)
    return words.select(*keep, tx.unigrams_and_bigrams(F.col("words")).alias("terms"))


def term_counts(texts: DataFrame, stop_words: Sequence[str], *keep: str) -> DataFrame:
    """Word and word-pair counts per text: ``keep`` columns, ``term``, ``tf``.

    The first of the kept columns identifies the text. Where the input is
    already partitioned by it, counting needs no shuffle.
    """
    # Outer: an inner generator would have Spark make the terms once more below it, and below a shuffle.
    return (
        _terms(texts, stop_words, *keep)
        .select(*keep, F.explode_outer("terms").alias("term"))
        .filter("term IS NOT NULL")
        .groupBy(*keep, "term")
        .agg(F.count("*").alias("tf"))
    )


def document_frequency(texts: DataFrame, stop_words: Sequence[str], key: str) -> DataFrame:
    """In how many texts each word or word pair occurs, and how often in all.

    A text's terms are sorted within its row, so the first of a run of equal terms
    counts for the text and every one for the occurrences. Texts are not shuffled;
    counts are, added up before that.
    """
    ordered = _terms(texts, stop_words, key).select(F.sort_array("terms").alias("terms"))
    first = F.transform(
        "terms",
        lambda t, i: F.struct(t.alias("term"), (F.get("terms", i - 1) == t).alias("again")),
    )
    # Outer: an inner generator would have Spark make the terms once more below it.
    marked = ordered.select(F.explode_outer(first).alias("t")).filter("t IS NOT NULL").select("t.*")
    return marked.groupBy("term").agg(
        F.count_if(~F.coalesce("again", F.lit(False))).alias("df"), F.count("*").alias("occurrences")
    )


def _totals(texts: DataFrame) -> Column:
    """(n_texts, n_terms) of all issues and records: how many have a text, and the most terms these can have."""
    rows = F.col("n_issues") + F.col("n_records")
    # A text of n characters has at most 2 (n + 1) / 3 words and word pairs.
    terms = F.size("words") * 2 if "words" in texts.columns else (F.length("text") + 1) * 2 / 3
    totals = F.struct(
        F.coalesce(F.sum(rows), F.lit(0)).cast("double").alias("n_texts"),
        F.sum(terms * rows).alias("n_terms"),
    )
    return texts.agg(totals.alias("totals")).scalar()


def _weight(tf: Column, df: Column, n_texts: Column) -> Column:
    return (F.log(tf.cast("double")) + 1) * (F.log((n_texts + 1) / (df + 1)) + 1)


def _distinct_terms(texts: DataFrame, stop_words: Sequence[str], *keep: str) -> DataFrame:
    """``keep`` columns and ``term``, a row for each different term of a text, made within the text's row."""
    # Outer: an inner generator would have Spark make the terms once more below it.
    terms = F.explode_outer(F.array_distinct("terms")).alias("term")
    return _terms(texts, stop_words, *keep).select(*keep, terms).filter("term IS NOT NULL")


def _record_weights(records: DataFrame, stop_words: Sequence[str], known: DataFrame, keep: Column, n_texts: Column) -> DataFrame:
    """(record_text, term, record_w): the records' unit vectors, by the frequencies ``known`` of their terms."""
    weighted = (
        term_counts(records, stop_words, "text_id")
        .join(known, "term")
        .filter(keep)
        .select("text_id", "term", _weight(F.col("tf"), F.col("df"), n_texts).alias("weight"))
    )
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("text_id")))
    return weighted.select(F.col("text_id").alias("record_text"), "term", (F.col("weight") / norm).alias("record_w"))


def _candidates(
    distinct: DataFrame, stop_words: Sequence[str], max_share: float, threshold: float
) -> DataFrame | None:
    """(text_id) of the issues' texts that may reach the threshold with some record; None if that cannot be told by broadcasts.

    The frequencies of the records' terms are exact. Other terms are counted by hash,
    which is never less than the frequency of one of them, so their weights, and the
    norms of the issues, are never too large.
    """
    records = materialize(distinct.filter("n_records > 0"), "record-texts")
    terms = materialize(_distinct_terms(records, stop_words, "text_id"), "record-terms")
    if terms.count() > _BROADCAST_TERMS:
        return None
    n_texts = _totals(distinct)["n_texts"]
    by_hash = F.pmod(F.xxhash64("term"), F.lit(_HASHES))
    own = F.broadcast(terms.select("term").distinct().withColumn("shared", F.lit(True)))
    counted = (
        _distinct_terms(distinct, stop_words, "n_issues", "n_records")
        .join(own, "term", "left")
        .groupBy(F.when(F.col("shared"), F.col("term")).alias("term"), F.when(F.col("shared").isNull(), by_hash).alias("hash"))
        .agg(F.sum(F.col("n_issues") + F.col("n_records")).alias("df"))
    )
    frequency = materialize(counted, "frequency-bounds")
    known = frequency.filter("term IS NOT NULL").select("term", "df")
    bounds = frequency.filter("term IS NULL").select("hash", F.col("df").alias("bound"))
    keep = F.col("df") <= F.lit(max_share) * n_texts
    vectors = materialize(_record_weights(records, stop_words, F.broadcast(known), keep, n_texts), "record-vectors")
    # Texts are dealt by their identity once; whatever is grouped by text after that stays where it is.
    issues = distinct.filter("n_issues > 0").repartition("text_id")
    df = F.coalesce("df", F.least("bound", n_texts))
    weighted = (
        term_counts(issues, stop_words, "text_id")
        .join(F.broadcast(known), "term", "left")
        .withColumn("hash", F.when(F.col("df").isNull(), by_hash))
        .join(F.broadcast(bounds), "hash", "left")
        .withColumn("df", df)
        .filter(keep)
        .select("text_id", "term", _weight(F.col("tf"), F.col("df"), n_texts).alias("w"))
    )
    # A text has a sum with each record and one with none, its own square.
    nobody = vectors.select("term").distinct().select(
        F.lit(None).cast("binary").alias("record_text"), "term", F.lit(None).cast("double").alias("record_w")
    )
    sums = (
        weighted.join(F.broadcast(materialize(vectors.union(nobody), "record-sides")), "term", "left")
        .groupBy("text_id", "record_text")
        .agg(F.sum(F.col("w") * F.coalesce("record_w", "w")).alias("sum"))
    )
    best = sums.groupBy("text_id").agg(
        F.sqrt(F.max(F.when(F.col("record_text").isNull(), F.col("sum")))).alias("norm"),
        F.max(F.when(F.col("record_text").isNotNull(), F.col("sum"))).alias("most"),
    )
    return materialize(best.filter(F.col("most") / F.col("norm") >= threshold - _SLACK).select("text_id"), "candidates")


def _chosen_texts(distinct: DataFrame, chosen: DataFrame) -> DataFrame:
    """The records' texts and those with a chosen id, written."""
    ids = chosen.withColumn("chosen", F.lit(True))
    if chosen.count() <= _BROADCAST_IDS:
        ids = F.broadcast(ids)
    return materialize(distinct.join(ids, "text_id", "left").filter("n_records > 0 OR chosen").drop("chosen"), "chosen-texts")


def _filtered(entries: DataFrame, terms: DataFrame) -> DataFrame:
    """The entries of ``terms``, and few others: a filter with some 16 bits for each term, by hash, is broadcast."""
    words = max(1, min(_FILTER_WORDS, terms.count() // 4))
    word = F.pmod(F.shiftrightunsigned(F.xxhash64("term"), 6), F.lit(words)).alias("word")
    bit = F.expr("shiftleft(1L, CAST(xxhash64(term) & 63 AS INT))")
    bits = terms.groupBy(word).agg(F.bit_or(bit).alias("bits"))
    marked = entries.withColumn("word", word).join(F.broadcast(bits), "word")
    return marked.filter(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def _weighted_terms(
    texts: _Texts, stop_words: Sequence[str], max_share: float, chosen: DataFrame | None = None
) -> DataFrame:
    """Weights before normalisation: text_id, n_issues, n_records, term, df, shared, weight.

    Terms found in more than ``max_share`` of all texts are dropped. ``shared``
    marks terms some record contains; the others only matter for the norm.
    With ``chosen`` text ids, of these texts and the records only; frequencies
    are those over all texts.

    Frequent terms would be hot keys of the join of terms with frequencies.
    At most ``_HOT_TERMS`` terms can each hold more than that fraction of all
    entries, so these few are broadcast and their entries get a join key salted
    by text.
    """
    totals = _totals(texts.distinct)
    n_texts, hot_from = totals["n_texts"], totals["n_terms"] / _HOT_TERMS
    wanted = texts.distinct if chosen is None else _chosen_texts(texts.distinct, chosen)
    counts = term_counts(wanted.repartition("text_id"), stop_words, "text_id", "n_issues", "n_records")
    # For frequencies a text's terms are made distinct within its row, before anything is grouped.
    entries = _distinct_terms(texts.distinct, stop_words, "n_issues", "n_records")
    if chosen is not None:
        terms = materialize(_distinct_terms(wanted, stop_words).distinct(), "wanted-terms")
        entries = _filtered(entries, terms)
    frequency = entries.groupBy("term").agg(
        F.count("*").alias("entries"),
        F.sum(F.col("n_issues") + F.col("n_records")).alias("df"),
        F.max(F.col("n_records") > 0).alias("shared"),
    )
    hot = frequency.filter(F.col("entries") > hot_from).select(
        "term", F.col("df").alias("hot_df"), F.col("shared").alias("hot_shared")
    )
    # A term of a single text needs no lookup: the text's own counts are its frequency.
    # Sorting by a 64-bit hash is cheap; the term itself stays part of the key.
    known = frequency.filter(F.col("entries") > 1).select(
        F.xxhash64("term").alias("key"), "term", "df", "shared"
    )
    salt = F.pmod(F.xxhash64("text_id"), F.lit(_SALTS))
    key = F.when(F.col("hot_df").isNotNull(), salt).otherwise(F.xxhash64("term"))
    return (
        counts.join(F.broadcast(hot), "term", "left")
        .withColumn("key", key)
        # The vocabulary outgrows the estimate made from the text files; never broadcast it.
        .join(known.hint("merge"), ["key", "term"], "left")
        .withColumn("df", F.coalesce("hot_df", "df", F.col("n_issues") + F.col("n_records")))
        .withColumn("shared", F.coalesce("hot_shared", "shared", F.col("n_records") > 0))
        .filter(F.col("df") <= F.lit(max_share) * n_texts)
        .select(
            "text_id",
            "n_issues",
            "n_records",
            "term",
            "df",
            "shared",
            _weight(F.col("tf"), F.col("df"), n_texts).alias("weight"),
        )
    )


def _vectors(weighted: DataFrame) -> DataFrame:
    """Unit vectors over shared terms: text_id, sides, term, w, tail, level.

    ``tail`` is the norm of a term together with the text's more frequent
    terms, ``level`` the power of two its document frequency has reached.
    Terms no record has are first summed into one entry per text, as only the
    norm needs them. The windows run over one text's own entries.
    """
    square = F.col("weight") * F.col("weight")
    entries = weighted.groupBy(
        "text_id", "n_issues", "n_records", F.when(F.col("shared"), F.col("term")).alias("term")
    ).agg(F.max("df").alias("df"), F.sum(square).alias("mass"))
    shared = F.col("term").isNotNull()
    frequent_first = Window.partitionBy("text_id").orderBy(F.desc("df"), "term")
    to_here = frequent_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = frequent_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        entries.withColumn("_total", F.sum("mass").over(whole))
        .withColumn("_running", F.sum(F.when(shared, F.col("mass")).otherwise(0.0)).over(to_here))
        .filter(shared)
        .select(
            "text_id",
            (F.col("n_issues") > 0).alias("of_issue"),
            (F.col("n_records") > 0).alias("of_record"),
            "term",
            F.sqrt(F.col("mass") / F.col("_total")).alias("w"),
            F.sqrt(F.col("_running") / F.col("_total")).alias("tail"),
            F.floor(F.log2("df")).cast("int").alias("level"),
        )
    )


def _classes(record_terms: DataFrame, floor: float) -> DataFrame:
    """(record_text, class): records by how frequent the terms are that could make a link by themselves.

    The class is the highest level from which on a record's terms have a norm of
    the threshold, in steps of four levels: at most 16 classes. Short records of
    common words so have a class of their own and do not weaken the bound of others.
    """
    highest = F.max(F.when(F.col("tail") >= floor, F.col("level")))
    return record_terms.groupBy(F.col("text_id").alias("record_text")).agg(
        F.coalesce(F.floor(highest / 4), F.lit(-1)).cast("int").alias("class")
    )


def _reach(record_terms: DataFrame) -> DataFrame:
    """Per class and level, the largest norm a record of the class has on terms at or above the level.

    A row per class and power of two, so at most 1,024 rows whatever the data.
    """
    upwards = Window.partitionBy("class").orderBy(F.desc("level")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    levels = F.explode(F.sequence(F.lit(0), F.lit(63))).alias("level")
    every = record_terms.select("class").distinct().select("class", levels)
    known = record_terms.groupBy("class", "level").agg(F.max("tail").alias("tail"))
    return every.join(known, ["class", "level"], "left").select(
        "class", "level", F.coalesce(F.max("tail").over(upwards), F.lit(0.0)).alias("reach")
    )


def _survivors(vectors: DataFrame, floor: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs that may reach the floor with what their prefix terms add; the issues' other terms; the records' terms."""
    of_record = vectors.filter("of_record")
    classes = materialize(_classes(of_record, floor), "record-classes")
    classed = of_record.withColumnRenamed("text_id", "record_text").join(classes, "record_text")
    reach = materialize(_reach(classed), "reach")
    record_terms = classed.select("record_text", "class", "term", F.col("w").alias("record_w"))
    # What a term and the more frequent ones after it can still add to any similarity.
    can_add = F.col("tail") * F.col("reach")
    issue_terms = (
        vectors.filter("of_issue")
        .join(F.broadcast(reach), "level")
        .select(F.col("text_id").alias("issue_text"), "class", "term", "w", can_add.alias("can_add"))
    )
    prefix = issue_terms.filter(F.col("can_add") >= floor * _REST)
    rest = issue_terms.filter(F.col("can_add") < floor * _REST)
    bounds = rest.groupBy("issue_text", "class").agg(F.max("can_add").alias("bound"))
    survivors = (
        prefix.join(record_terms, ["class", "term"])
        .groupBy("issue_text", "record_text", "class")
        .agg(F.sum(F.col("w") * F.col("record_w")).alias("sum"))
        .join(bounds, ["issue_text", "class"], "left")
        .filter(F.col("sum") + F.coalesce("bound", F.lit(0.0)) >= floor)
        .select("issue_text", "record_text", "class", "sum")
    )
    return survivors, rest, record_terms


def _similar_texts(vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs of an issue's and a record's text with a similarity at or above the threshold."""
    survivors, rest, record_terms = _survivors(vectors, threshold - _SLACK)
    added = F.coalesce(F.col("w") * F.col("record_w"), F.lit(0.0))
    return (
        survivors.join(rest, ["issue_text", "class"], "left")
        .join(record_terms.drop("class"), ["record_text", "term"], "left")
        .groupBy("issue_text", "record_text")
        .agg((F.max("sum") + F.sum(added)).alias("similarity"))
        .withColumn("similarity", F.least("similarity", F.lit(1.0)))
        .filter(F.col("similarity") >= threshold)
    )


def link_texts(
    issues: DataFrame,
    records: DataFrame,
    *,
    threshold: float = THRESHOLD,
    max_share: float = MAX_DOCUMENT_SHARE,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Links between (node_id, text) rows and (corpus_id, external_id, text) rows.

    The distinct texts' words and the term vectors, limited to terms the records
    contain, are written to the shared folder once, as later reads of them would each repeat
    what made them. Without issues, records or common words there are no links.
    """
    if threshold <= 0:
        raise ValueError("threshold must be above 0: every pair is similar by 0 or more")
    if not records.filter(F.col("text").isNotNull()).take(1):
        # Nothing to link with: the issues' terms are of no use.
        return empty(issues.sparkSession, CROSS_LINKS)
    stop_words = english_stop_words() if stop_words is None else stop_words
    texts = _texts(issues, records)
    texts = texts._replace(distinct=materialize(_tokenised(texts.distinct, stop_words), "texts"))
    near = _candidates(texts.distinct, stop_words, max_share, threshold)
    vectors = materialize(
        _vectors(_weighted_terms(texts, stop_words, max_share, near)), "vectors"
    )
    links = (
        _similar_texts(vectors, threshold)
        .join(texts.issues.withColumnRenamed("text_id", "issue_text"), "issue_text")
        .join(texts.records.withColumnRenamed("text_id", "record_text"), "record_text")
        .withColumn("method", F.lit("semantic"))
    )
    return conform(links, CROSS_LINKS)


def link_issues(issues: DataFrame, records: DataFrame, **options) -> DataFrame:
    """Links of issue rows; the text compared is framework, title and body."""
    return link_texts(match_texts(issues), records, **options)


def links_at(links: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """How many links there are at each of several thresholds."""
    steps = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    return (
        links.select("similarity", steps)
        .groupBy("threshold")
        .agg(F.count_if(F.col("similarity") >= F.col("threshold")).alias("n_links"))
    )


def top_links(links: DataFrame, k: int) -> DataFrame:
    """The ``k`` strongest links."""
    return links.orderBy(F.desc("similarity"), "node_id", "corpus_id", "external_id").limit(k)


def links_per_record(links: DataFrame, issues: DataFrame) -> DataFrame:
    """For each linked record, its issues, their frameworks and its best similarity."""
    return (
        links.join(issues.select("node_id", "framework_slug"), "node_id")
        .groupBy("corpus_id", "external_id")
        .agg(
            F.count("*").alias("n_issues"),
            F.count_distinct("framework_slug").alias("n_frameworks"),
            F.max("similarity").alias("best_similarity"),
        )
    )


def linked_issues(issues: DataFrame, links: DataFrame) -> DataFrame:
    """Issues that have at least one link."""
    return issues.join(links.select("node_id"), "node_id", "left_semi")
