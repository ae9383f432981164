"""What several operators share: whole texts as bytes, words, and folders all executors reach."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule, as a character class and as characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _joined_with_later(step: int) -> Callable[[Column], Column]:
    """Each hash combined with the one ``step`` places later; the last few have no partner."""

    def join(h: Column) -> Column:
        later = F.slice(h, F.lit(step + 1), F.greatest(F.size(h) - step, F.lit(0)))
        return F.zip_with(h, later, lambda a, b: F.xxhash64(a, b))

    return join


def window_hashes(found: Column, window: int) -> Column:
    """A hash for every window of words, by doubling; ``window`` is a power of two."""
    hashes, step = F.transform(found, lambda w: F.xxhash64(w)), 1
    while step < window:
        hashes = let(hashes, _joined_with_later(step))
        step *= 2
    return F.slice(hashes, F.lit(1), F.greatest(F.size(found) - (window - 1), F.lit(0)))


#: Fewer keys than this can each hold more than this share of all rows.
HOT_KEYS = 1_000


def join_facts(rows: DataFrame, facts: DataFrame, key: str | list[str], total: int) -> DataFrame:
    """Rows with the facts of their key; rows without facts go.

    ``facts`` is a written table with one row per key, whose column ``n`` tells how
    many of the ``total`` rows have the key. Keys with more than their share are
    fewer than ``HOT_KEYS``, so their facts are broadcast and their rows stay where
    they are; no key of the rest is large enough to burden a task of the shuffle.
    """
    hot = F.col("n") * HOT_KEYS > total
    keys = [key] if isinstance(key, str) else key
    loud, rest = facts.filter(hot).drop("n"), facts.filter(~hot).drop("n")
    kinds = {r["hot"] for r in facts.select(hot.alias("hot")).distinct().collect()}
    if True not in kinds:
        return rows.join(rest, keys)
    found = rows.join(F.broadcast(loud), keys)
    if False not in kinds:
        return found
    quiet = rows.join(F.broadcast(loud.select(keys)), keys, "left_anti")
    return found.unionByName(quiet.join(rest, keys))


def has_rows(df: DataFrame) -> bool:
    return bool(df.take(1))


#: Rows and bytes of the batches in which Spark hands whole texts to Python workers.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def small_batches(spark: SparkSession) -> None:
    """Let workers get texts in small batches, from now on, unless the session says how large they are.

    Each running task has a batch several times over: as Arrow vectors, which double
    as they grow, and in the stream's buffer, both outside the executor's heap, and in
    its worker, together with the next.
    """
    said = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in said:
            spark.conf.set(key, value)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of whole texts; a null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that what Python makes of one stays small."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def pieces(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of texts of about ``limit`` bytes. A text is never cut; one above the limit is alone."""
    a = size = 0
    for b, text in enumerate(texts):
        if b > a and size + len(text) > limit:
            yield a, b
            a, size = b, 0
        size += len(text)
    if a < len(texts):
        yield a, len(texts)


class WordHashes(dict):
    """64-bit hashes of words as eight bytes, remembered for the words met last.

    Joining the values of a text's words gives an array of hashes without a
    Python number per word. The memory is bounded: a full table starts anew.
    """

    def __init__(self, seed: int = 0, limit: int = 250_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed).to_bytes(8, "little")
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, found)), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system, as a Python worker lives on for later tasks. Where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_kept: dict[Hashable, object] = {}


def kept(owner: Hashable, make: Callable[[], object]):
    """What an operator keeps in a worker between tasks, such as tables of words.

    A worker outlives an operator, so it keeps the things of one owner at a time:
    those of the last go, and their memory with them, when another asks.
    """
    if owner not in _kept:
        forget()
        _kept[owner] = make()
    return _kept[owner]


def forget() -> None:
    """Drop what this worker keeps."""
    if _kept:
        _kept.clear()
        give_back()


def batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """Columns as lists, numpy arrays or Arrow arrays."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for f, c in ((f, columns[f.name]) for f in schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
