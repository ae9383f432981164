"""Spelling variants by a bit-sliced position index of the vocabulary.

1. Runs of letters are counted over all texts. Words are those with enough letters
   and occurrences.
2. Two words are near if one letter inserted, deleted or replaced makes them equal.
   Let m be the length of the shorter: the edit lies behind the first half of its
   letters, which both words share, or before the last half. So each word goes to
   the keys (m, first half) and (m, last half) for m its length and one less. A key
   with more than ``CROWD`` words is split in the same way: the edit lies behind
   the first or before the last half of the letters not yet shared. Keys get
   smaller until one letter is left, which an alphabet bounds; rows at most double
   with each step, and no pair is left out.
3. Keys of one length are dealt into blocks. A block has an index: for each position
   and letter the set of its words with that letter there, a bit for each word. For
   all words of length m at once, and for 64 indexed words at a time, recurrences
   over the positions follow which words agree so far (zero errors), which have one
   letter replaced, and which have one letter more, whose letters agree one
   position further on. Only near pairs leave the task.
4. A word's form is its near word with the most occurrences, if that has enough
   more; roots follow forms to the last, which at least multiplies the occurrences
   by ``ratio``, so there are no rounds and few steps.

Null texts have no words. A null id counts as an empty text where ids matter (see
``misspell``). Repeated rows count each time. Ties go to the first in code-point
order. Without words there are no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import batch, has_rows, join_facts, sliced, texts_as_bytes
from faultloom.session import materialize

LETTERS = "a-zÀ-ÿ"
MIN_LETTERS, MIN_COUNT, RATIO = 6, 5, 5
#: Words of a key that is not split further, rows of a block on average, words looked up at once, words counted before they are sent.
CROWD, BLOCK, QUERIES, FLUSH = 2_048, 2_048, 512, 300_000

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def misspelt(run: str, before: int, every: int) -> str:
    """The run, or, if ``every`` divides its hash behind the id's, the run without a letter."""
    h = zlib.crc32(run.encode(), before)
    if h % every:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _count(min_letters: int, misspell: int | None):
    runs = re.compile(f"[{LETTERS}]{{{min_letters},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in sliced(batches):
            ids = part.column(0).to_pylist()
            for id, text in zip(ids, texts_as_bytes(part.column(1)), strict=True):
                before = zlib.crc32(f"{id or ''}:".encode())
                for found, n in Counter(runs.findall(text.lower().decode())).items():
                    word = misspelt(found, before, misspell) if misspell else found
                    if len(word) >= min_letters:
                        seen[word] += n
                if len(seen) >= FLUSH:
                    yield batch(_COUNTS, {"word": list(seen), "n": list(seen.values())})
                    seen.clear()
        yield batch(_COUNTS, {"word": list(seen), "n": list(seen.values())})

    return run


def vocabulary(
    docs: DataFrame, id: str, text: str, min_letters: int, min_count: int, misspell: int | None
) -> DataFrame:
    """(word, n) of the words that count."""
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_count(min_letters, misspell), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


_KEY = ["m", "a", "b", "head", "tail"]


def _halved(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, a, b) that share a letters before and b behind the edit, once for each half of the rest."""
    middle = (F.col("a") + F.floor((F.col("m") - F.col("a") - F.col("b")) / 2)).cast("int")
    halves = F.array(
        F.struct(middle.alias("a"), F.col("b").alias("b")),
        F.struct(F.col("a").alias("a"), (F.col("m") - middle).alias("b")),
    )
    spread = rows.select("word", "n", "m", F.explode(halves).alias("h")).select("word", "n", "m", "h.a", "h.b")
    return spread.withColumns({
        "head": F.substring("word", F.lit(1), F.col("a")),
        "tail": F.right("word", F.col("b")),
    })


def _in_classes(words: DataFrame, min_letters: int) -> DataFrame:
    """Each word with the lengths that the shorter of a pair with it can have."""
    length = F.char_length("word").cast("int")
    classes = F.filter(F.array(length, length - 1), lambda m: m >= min_letters)
    none = F.lit(0).alias("a"), F.lit(0).alias("b")
    return words.select("word", "n", F.explode(classes).alias("m"), *none)


def members(words: DataFrame, min_letters: int) -> DataFrame:
    """(word, n, key columns) of keys that several words share, none of them crowded."""
    done, rows, total = [], _halved(_in_classes(words, min_letters)), 4 * words.count()
    while True:
        sizes = rows.groupBy(_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sizes = materialize(sizes.withColumn("size", F.col("n")), "key-sizes")
        found = materialize(join_facts(rows, sizes, _KEY, total), "key-members")
        crowded = (F.col("size") > CROWD) & (F.col("m") - F.col("a") - F.col("b") > 1)
        done.append(found.filter(~crowded))
        rest = found.filter(crowded)
        if not has_rows(rest):
            return reduce(DataFrame.union, done)
        rows, total = _halved(rest.select("word", "n", "m", "a", "b")), 2 * rest.count()


class PositionIndex:
    """For each (position, letter) the words that have it, as bits; words have m letters, or one more."""

    def __init__(self, words: list[str], m: int):
        points = np.zeros((len(words), m + 1), np.uint32)
        for k, w in enumerate(words):
            points[k, : len(w)] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
        letters, codes = np.unique(points, return_inverse=True)
        self.m, self.codes = m, codes.reshape(points.shape)
        self.size = len(words)
        self.bits = np.stack([self._packed(self.codes[:, p] == np.arange(len(letters))[:, None]) for p in range(m + 1)])
        longer = np.array([len(w) > m for w in words])
        self.shorter = np.flatnonzero(~longer)
        self.is_short, self.is_long = self._packed(~longer), self._packed(longer)

    def _packed(self, flags: np.ndarray) -> np.ndarray:
        """Flags of words along the last axis as 64-bit words."""
        padded = np.zeros((*flags.shape[:-1], -(-self.size // 64) * 64), bool)
        padded[..., : self.size] = flags
        return np.packbits(padded, axis=-1, bitorder="little").view("<u8")

    def near(self, queries: np.ndarray) -> np.ndarray:
        """For words of m letters, by number: the bits of all words one edit away."""
        shape = len(queries), self.bits.shape[2]
        equal, replaced, longer = np.full(shape, ~np.uint64(0)), np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        for p in range(self.m):
            letter = self.codes[queries, p]
            here, further = self.bits[p, letter], self.bits[p + 1, letter]
            longer = (longer | equal) & further
            replaced = (replaced & here) | (equal & ~here)
            equal &= here
        return (replaced & self.is_short) | ((longer | equal) & self.is_long)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(shorter or equally long word, near word) by number, some queries at a time."""
        for lo in range(0, len(self.shorter), QUERIES):
            queries = self.shorter[lo : lo + QUERIES]
            bits = np.unpackbits(self.near(queries).view(np.uint8), axis=1, bitorder="little")
            i, j = np.nonzero(bits[:, : self.size])
            yield queries[i], j


_NEAR = "word string, near string, near_n long"


def _near_words(key: tuple, table: pa.Table) -> pa.Table:
    """(word, near, near_n), in both directions, of one block."""
    count_of = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True))
    words, m = sorted(count_of), key[0].as_py()
    n, longer = np.array([count_of[w] for w in words]), np.array([len(w) > m for w in words])
    one, two = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in PositionIndex(words, m).pairs():
        # Words of equal length meet from both sides; a longer one is found from the shorter alone.
        back = longer[j]
        one += [i, j[back]]
        two += [j, i[back]]
    one, two = np.concatenate(one), np.concatenate(two)
    names = pa.array(words, pa.string())
    return pa.table({"word": names.take(pa.array(one)), "near": names.take(pa.array(two)), "near_n": pa.array(n[two], pa.int64())})


def near_words(words: DataFrame, min_letters: int) -> DataFrame:
    """(word, near, near_n): all near pairs of (word, n), in both directions, once each."""
    found = members(words, min_letters)
    blocks = found.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = found.join(materialize(blocks, "blocks"), "m")
    at = F.pmod(F.xxhash64(*_KEY), F.col("blocks"))
    return dealt.select("m", at.alias("at"), "word", "n").groupBy("m", "at").applyInArrow(_near_words, _NEAR).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form, by pointers that double their reach."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not has_rows(state.join(ahead, "root", "left_semi")):
            return state
        state = materialize(state.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "word-roots")


def variants(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    misspell: int | None = None,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word.

    ``misspell`` plants errors that can be looked for: of the runs of a document
    whose hash with its id the number divides, one letter is left out.
    """
    words = materialize(vocabulary(docs, id, text, min_letters, min_count, misspell), "vocabulary")
    near = near_words(words, min_letters)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best")
    per_word = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    enough: Column = -F.col("best.rank") >= ratio * F.col("n")
    judged = words.join(per_word, "word", "left").select(
        "word", "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.rank")).alias("form_n"),
    )
    judged = materialize(judged, "word-forms")
    out = judged.join(_roots(judged.filter("form IS NOT NULL")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
