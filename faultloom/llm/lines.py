"""Line deduplication by a deletion-neighbourhood join, in SQL functions alone.

A line is the words between two newlines; the edit bound is one word inserted,
deleted or replaced. Each line emits itself and every variant with one word left
out, as hashed keys. Lines with an equal key at the same place differ in that one
word; a line equal to another's variant is that other less a word. Partners found
by hash are verified on their words. Of lines within the bound of each other, and
of equal lines, the earliest by (id, line number, hash of the text) is kept: an occurrence goes if
any earlier line is equal or within the bound, whether or not that one stays.

Equal lines go whatever their length; lines without a word stay. One-edit partners are
looked for among lines of ``MIN_WORDS`` words and more: shorter ones differ by a word
without being copies.

Equal lines are one before all else. Lines within the bound share their first or
last half of words, so only lines that share such a half emit variants. For a key
that many lines share, the earliest is found by an aggregate that Spark combines
before its shuffle and is joined back: groups are never gathered, and all lines
of a group are compared with its earliest only.

Null texts are empty. Null ids come first in the order. Rows that repeat an id and
its text are one document's: their lines are kept or go together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import free_name, join_facts, let, words
from faultloom.session import materialize

MIN_WORDS = 5
#: A broadcast table's bytes at most; by its rows and the bytes of one.
BROADCAST_BYTES = 16 << 20
#: Words of a line that are summed up in one go.
BLOCK = 256


def _version(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _parts(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(line, at, halves) of lines with a word: a digest of the words, the place, what near lines share."""
    rows = docs.select(F.col(id).alias("doc_id"), _version(text).alias("version"), _parts(text).alias("parts"))
    # Outer: an inner generator would have Spark split once more below it.
    found = rows.select("doc_id", "version", F.posexplode_outer("parts").alias("line_no", "part"))
    split = found.withColumn("ws", words(F.col("part"))).withColumn("n", F.size("ws"))
    return split.filter(F.col("n") > 0).select(
        F.unhex(F.md5(F.array_join("ws", " "))).alias("line"),
        F.struct("doc_id", "line_no", "version").alias("at"),
        F.when(F.col("n") >= MIN_WORDS, _halves()).alias("halves"),
    )


def _halves() -> Column:
    """Hashes of the first and last words, as many as this line and one a word longer or shorter share."""

    def half(n: Column) -> list[Column]:
        m = F.floor((n - 1) / 2).cast("int")
        tail = F.slice("ws", F.col("n") - m + 1, m)
        return [F.xxhash64(F.lit("first"), m, F.slice("ws", F.lit(1), m)), F.xxhash64(F.lit("last"), m, tail)]

    return F.array_distinct(F.array(*half(F.col("n")), *half(F.col("n") - 1)))


def _fits(rows: int, width: int) -> bool:
    return rows * width <= BROADCAST_BYTES


def _if_few(df: DataFrame, width: int) -> DataFrame:
    """A written table with rows of ``width`` bytes, marked for broadcast if they fit."""
    return F.broadcast(df) if _fits(df.count(), width) else df


def _distinct(lines: DataFrame) -> DataFrame:
    """(line, at, halves, k): each different line, its earliest place, and how often it occurs."""
    return lines.groupBy("line").agg(
        F.min("at").alias("at"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("k")
    )


def _candidates(docs: DataFrame, known: DataFrame, id: str, text: str) -> DataFrame:
    """(line, at, ws) of lines that share a half with another line; their words are read where they lie first."""
    long = known.filter("halves IS NOT NULL")
    spread = long.select("line", "at", F.explode_outer("halves").alias("half"))
    shared = spread.groupBy("half").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    shared = _if_few(materialize(shared.select("half"), "shared-halves"), 16)
    some = materialize(spread.join(shared, "half", "left_semi").select("line", "at").distinct(), "line-candidates")
    per_doc = some.groupBy(F.col("at.doc_id").alias("_id"), F.col("at.version").alias("_version")).agg(
        F.collect_list(F.struct("line", "at")).alias("wanted")
    )
    # Grouped, a line's share is its digest and place.
    per_doc = F.broadcast(per_doc) if _fits(some.count(), 64) else per_doc
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    met = rows.join(per_doc, _same(F.col("id"), F.col("text")))
    found = met.select(_parts("text").alias("parts"), F.explode_outer("wanted").alias("w"))
    lines = found.select("w.line", "w.at", words(F.get("parts", F.col("w.at.line_no"))).alias("ws"))
    return lines.dropDuplicates(["line"])


def _rest(ws: str | Column, place: Column) -> Column:
    """The words without the one at a place; 0 leaves all."""
    before = F.slice(ws, F.lit(1), F.greatest(place - 1, F.lit(0)))
    return F.when(place == 0, F.col(ws)).otherwise(
        F.concat(before, F.slice(ws, place + 1, F.size(ws)))
    )


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _running(hashes: Column) -> Column:
    """The exclusive-or of each hash and all before it; for arrays of moderate length, as each step copies."""
    none = F.array().cast("array<bigint>")
    last = lambda seen: F.coalesce(F.get(seen, F.size(seen) - 1), F.lit(0).cast("long"))
    return F.aggregate(hashes, none, lambda seen, h: F.concat(seen, F.array(_xor(last(seen), h))))


def _running_xor(hashes: Column) -> Column:
    """The same for arrays of any length, block by block; each block then takes up the sum of those before it."""
    nothing = F.lit(0).cast("long")

    def joined(blocks: Column) -> Column:
        sums = _running(F.transform(blocks, lambda b: F.get(b, F.size(b) - 1)))
        before = F.concat(F.array(nothing), F.slice(sums, F.lit(1), F.size(sums) - 1))
        return F.flatten(F.zip_with(blocks, before, lambda b, s: F.transform(b, lambda h: _xor(h, s))))

    def in_blocks(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(x), F.lit(BLOCK))
        return F.transform(starts, lambda k: _running(F.slice(x, k, F.lit(BLOCK))))

    return let(hashes, lambda x: F.when(F.size(x) <= BLOCK, _running(x)).otherwise(let(in_blocks(x), joined)))


def variant_keys(ws: Column) -> Column:
    """At 0 the key of the words, at i the key of the words without the i-th.

    A key is the exclusive-or of hashes of (word, place). Without the i-th word, those
    before it keep their places and those behind it move up by one: all moved, then
    the first i put back, then the i-th taken out. Linear in the words.
    """
    nothing = F.lit(0).cast("long")

    def keys(own: Column) -> Callable[[Column], Column]:
        def of(moved: Column) -> Column:
            all_moved = F.aggregate(moved, nothing, _xor)
            back = _running_xor(F.zip_with(own, moved, _xor))
            out = let(all_moved, lambda m: F.zip_with(back, own, lambda b, h: _xor(_xor(m, b), h)))
            return F.concat(F.array(F.aggregate(own, nothing, _xor)), out)

        return of

    placed = F.transform(ws, lambda w, i: F.xxhash64(w, i))
    moved = F.transform(ws, lambda w, i: F.xxhash64(w, i - 1))
    return let(placed, lambda own: let(moved, keys(own)))


def _variants(lines: DataFrame) -> DataFrame:
    """(key, place, line, at): the line itself at place 0, and the line without each of its words."""
    return lines.select("line", "at", F.posexplode_outer(variant_keys(F.col("ws"))).alias("place", "key"))


def _partners(variants: DataFrame) -> DataFrame:
    """(line, place, other, other_place) where the other is the earliest of its kind and earlier than the line."""
    shared = variants.groupBy("key").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("key")
    shared = _if_few(materialize(shared, "shared-variants"), 16)
    variants = materialize(variants.join(shared, "key", "left_semi"), "line-variants")
    who = F.struct("at", "line", "place")
    left_out = F.col("place") > 0
    same_place = (
        variants.filter(left_out)
        .groupBy("key", "place")
        .agg(F.min(who).alias("best"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1")
        .select("key", "place", "best")
    )
    replaced = variants.join(same_place, ["key", "place"])
    by_key = (
        variants.groupBy("key")
        .agg(F.min(F.when(~left_out, who)).alias("whole"), F.min(F.when(left_out, who)).alias("longer"))
        .filter("whole IS NOT NULL AND longer IS NOT NULL")
    )
    grown = variants.join(by_key, "key").withColumn("best", F.when(left_out, F.col("whole")).otherwise(F.col("longer")))
    columns = ["line", "at", "place", "best"]
    both = replaced.select(columns).union(grown.select(columns)).filter("best.at < at")
    return both.select("line", "place", F.col("best.line").alias("other"), F.col("best.place").alias("other_place")).distinct()


def _shadowed(candidates: DataFrame) -> DataFrame:
    """(line) of those with a verified earlier line within the bound."""
    pairs = _partners(_variants(candidates))
    mine = candidates.select("line", "ws")
    theirs = candidates.select(F.col("line").alias("other"), F.col("ws").alias("other_ws"))
    both = pairs.join(mine, "line").join(theirs, "other")
    # With the same place, or all of one side, equal rests are one edit.
    one_edit = _rest("ws", F.col("place")) == _rest("other_ws", F.col("other_place"))
    return both.filter(one_edit).select("line").distinct()


def removed_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, version, near): the occurrences that go; ``near`` if no earlier line is equal."""
    lines = materialize(_lines(docs, id, text), "lines")
    known = materialize(_distinct(lines), "distinct-lines")
    candidates = materialize(_candidates(docs, known, id, text), "candidate-lines")
    shadowed = materialize(_shadowed(candidates), "shadowed-lines").withColumn("shadowed", F.lit(True))
    fate = known.select("line", F.col("at").alias("first"), F.col("k").alias("n")).join(shadowed, "line", "left")
    fate = materialize(fate.filter("n > 1 OR shadowed"), "line-fates")
    places = lines.select("line", "at")
    met = places.join(F.broadcast(fate), "line") if _fits(fate.count(), 64) else join_facts(places, fate, "line", lines.count())
    first = F.col("at").eqNullSafe(F.col("first"))
    return met.filter(~first | F.col("shadowed")).select("at.*", first.alias("near"))


def _per_document(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(_id, _version, removed, n_near), a row for each document that loses lines."""
    gone = removed_lines(docs, id, text).distinct()
    numbers = F.sort_array(F.collect_list("line_no")).alias("removed")
    found = gone.groupBy("doc_id", "version").agg(numbers, F.count_if("near").alias("n_near"))
    return materialize(found.withColumnsRenamed({"doc_id": "_id", "version": "_version"}), "removed-lines")


def _same(id: Column, text: Column) -> Column:
    return id.eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_version"))


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, n_near, removed_lines) for every row; line numbers from 0, with commas."""
    gone = _per_document(docs, id, text)
    n_lines = F.size(_parts(text)).cast("long")
    narrow = docs.select(F.col(id).alias("doc_id"), _version(text).alias("version"), n_lines.alias("n_lines"))
    same = narrow["doc_id"].eqNullSafe(gone["_id"]) & (narrow["version"] == gone["_version"])
    return narrow.join(gone, same, "left").select(
        "doc_id", "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )


def filtered(docs: DataFrame, id: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns, the text without the lines that go, its length renewed. Nothing left is an empty text."""
    gone = _per_document(docs, id, text)
    at, version, numbers = (free_name(docs, n) for n in ("removed_from", "removed_version", "removed_lines"))
    gone = gone.select(F.col("_id").alias(at), F.col("_version").alias(version), F.col("removed").alias(numbers))
    body = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    joined = docs.join(gone, docs[id].eqNullSafe(F.col(at)) & (body == F.col(version)), "left")
    left = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(numbers, i))
    renewed = joined.withColumn(text, F.when(F.col(numbers).isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    if length in docs.columns:
        own = F.when(F.col(numbers).isNull(), F.col(length)).otherwise(F.length(text))
        renewed = renewed.withColumn(length, own.cast(docs.schema[length].dataType))
    return renewed.select(docs.columns)


def oracle_sql() -> str:
    return rf"""
WITH p AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT doc_id, i AS line_no, regexp_extract_all(ls[i + 1], '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM p)
), k AS (
  SELECT doc_id, line_no, ws, array_to_string(ws, ' ') AS line FROM l WHERE len(ws) > 0
), d AS (
  SELECT line, any_value(ws) AS ws, min({{'a': doc_id, 'b': line_no}}) AS place FROM k GROUP BY line
), m AS (
  SELECT * FROM d WHERE len(ws) >= {MIN_WORDS}
), v AS (
  SELECT line, place, i, array_to_string(ws[:i - 1] || ws[i + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM m)
), e AS (
  SELECT rest, i, min(place) AS place FROM v GROUP BY ALL
), shadowed AS (
  SELECT v.line FROM v JOIN e ON v.rest = e.rest AND v.i = e.i AND e.place < v.place
  UNION SELECT v.line FROM v JOIN m ON v.rest = m.line AND m.place < v.place
  UNION SELECT m.line FROM v JOIN m ON v.rest = m.line AND v.place < m.place
), gone AS (
  SELECT k.doc_id, k.line_no, {{'a': k.doc_id, 'b': k.line_no}} = d.place AS near
  FROM k JOIN d USING (line) LEFT JOIN shadowed s ON s.line = k.line
  WHERE {{'a': k.doc_id, 'b': k.line_no}} <> d.place OR s.line IS NOT NULL
), g AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (near) AS n_near,
    string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS removed_lines FROM gone GROUP BY doc_id
)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_near, 0) AS n_near, coalesce(removed_lines, '') AS removed_lines
FROM p LEFT JOIN g USING (doc_id)"""
