"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of word pairs are quantised to 1 + floor(log_BASE(count)),
and a filter holds, for an n-gram of quantised count q, the entries (n-gram, 1)
to (n-gram, q). Its count is read back by probing for entry 1, 2, ... until one
is missing. Word probabilities are add-half estimates from these counts; a pair's
count is smoothed towards them with ``PRIOR`` pseudo-counts of its first word:

    p(w | v) = (min(c(v w), c(v), c(w)) + PRIOR * p(w)) / (c(v) + PRIOR)

so a false hit of the filter counts no more than the rarer of its two words.

The filter is made of segments, one for each ``SEGMENT_TOKENS`` training tokens.
N-grams are dealt to segments by hash, counted and set where they land, so one
shuffle counts and builds. A segment has ``ENTRY_BITS`` bits for each entry it
holds, so the error rate is the same for every corpus. A filter of at most
``BROADCAST_BYTES`` is broadcast. A larger one stays where it was written: texts
are dealt into chunks, the different n-grams of a chunk are sent to their
segments, in order and as differences, one row for a chunk and segment, and the
levels found there, a byte each, return to the chunk, which makes its n-grams
once more. Scores are the same.

Exact counts of words, for the base score: the most frequent words (at most
``HOT_WORDS``) are broadcast; all others are joined by word, per document and
word one row.

A null text is empty: its end is its only token. Null ids belong to the training
part and are scored row by row, as repeated ids are. Without training rows all
counts are 0. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import WordHashes, batch, mixed, pieces, sliced, small_batches, texts_as_bytes
from faultloom.session import materialize

FOLDS, HELD_OUT = 5, 1
BASE, PRIOR = 1.5, 10.0
SEGMENT_TOKENS, ENTRY_BITS, BROADCAST_BYTES = 1 << 20, 9, 160 << 20
HOT_WORDS, FLUSH_WORDS, FLUSH_PAIRS, TEXT_BYTES = 200_000, 300_000, 2_000_000, 1 << 22

#: The end of a text as a token; no word has white space.
END = b"\n"
_PAIR, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_HALF, _LOW, _BIT = np.uint64(32), np.uint64((1 << 32) - 1), np.uint64(63)


def held_out(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def tokens(text: bytes) -> list[bytes]:
    found = text.lower().split()
    found.append(END)
    return found


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for b in sliced(batches, 1_500):
        texts = texts_as_bytes(b.column(column))
        for lo, hi in pieces(texts, TEXT_BYTES):
            yield b.slice(lo, hi - lo), texts[lo:hi]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, seen = pa.schema([("token", pa.binary()), ("n", pa.int64())]), Counter()
    for _, texts in _batches(batches, 0):
        for t in texts:
            seen.update(tokens(t))
        if len(seen) >= FLUSH_WORDS:
            yield batch(schema, {"token": list(seen), "n": list(seen.values())})
            seen.clear()
    yield batch(schema, {"token": list(seen), "n": list(seen.values())})


def pair_grams(hashes: np.ndarray) -> np.ndarray:
    """A gram for each token with the one before it; the first follows an end."""
    before = np.concatenate([hashes[-1:], hashes[:-1]])
    return mixed(before * _PAIR + hashes)


def _segment(grams: np.ndarray, segments: int) -> np.ndarray:
    return ((grams >> _HALF) * np.uint64(segments)) >> _HALF


def _count_grams(segments: int):
    schema = pa.schema([("segment", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        grams, n = np.unique(np.concatenate(parts), return_counts=True)
        return batch(schema, {"segment": _segment(grams, segments).astype(np.int32), "gram": grams.view(np.int64), "n": n})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, parts, size = WordHashes(), [], 0
        for _, texts in _batches(batches, 0):
            for t in texts:
                hashes = known.of(tokens(t))
                parts += [hashes, pair_grams(hashes)]
                size += 2 * len(hashes)
            if size >= FLUSH_PAIRS:
                yield counted(parts)
                parts, size = [], 0
        if parts:
            yield counted(parts)

    return run


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised counts, 1 and more. The small addend keeps powers of the base on their side."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a level; 0 for 0."""
    top = int(levels.max(initial=0))
    low = np.ceil(BASE ** np.arange(top + 1) - 1e-6)
    middle = np.concatenate([[0.0], (low[:-1] + np.maximum(low[1:] - 1, low[:-1])) / 2])
    return middle[levels]


def _places(grams: np.ndarray, at: int, size: np.ndarray | np.uint64) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """An entry (gram, at) is three bits in each of two 64-bit words of the ``size`` of its segment: (word, bits) twice.

    A probe so reads memory in two places at most.
    """
    h = mixed(grams + np.array([at], np.uint64) * _LEVEL)
    g = h * _PAIR
    bits = [(g >> np.uint64(58 - 6 * k)) & _BIT for k in range(6)]
    return [(((h & _LOW) * size) >> _HALF, bits[:3]), (((h >> _HALF) * size) >> _HALF, bits[3:])]


_SEGMENT = pa.schema([("segment", pa.int32()), ("size", pa.int64()), ("top", pa.int64()), ("bits", pa.binary())])


def _built(segment: int, grams: np.ndarray, levels: np.ndarray, entry_bits: float) -> pa.RecordBatch:
    """One segment: its 64-bit words, as many as its entries need, and its highest level."""
    size, top = math.ceil(int(levels.sum()) * entry_bits / 64), int(levels.max())
    bits = np.zeros(size << 6, np.uint8)
    for at in range(1, top + 1):
        for word, places in _places(grams, at, np.uint64(size)):
            for bit in places:
                bits[(word << np.uint64(6)) | bit] = 1
        more = levels > at
        grams, levels = grams[more], levels[more]
    return batch(_SEGMENT, {"segment": [segment], "size": [size], "top": [top], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _build(entry_bits: float):
    """Segments from rows that come ordered by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, grams, levels = None, [], []
        for b in batches:
            segment = b.column("segment").to_numpy()
            gram, found = b.column("gram").to_numpy().view(np.uint64), level(b.column("n").to_numpy())
            for s in np.unique(segment):
                if s != current:
                    if grams:
                        yield _built(current, np.concatenate(grams), np.concatenate(levels), entry_bits)
                    current, grams, levels = int(s), [], []
                own = segment == s
                grams.append(gram[own])
                levels.append(found[own])
        if grams:
            yield _built(current, np.concatenate(grams), np.concatenate(levels), entry_bits)

    return run


class Filter:
    """Segments end to end, and the probes that read counts from them."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, top: int):
        """``sizes`` in words of the segments, and the highest level any n-gram has."""
        self.sizes, self.words, self.top = sizes.astype(np.uint64), words, top
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)

    @classmethod
    def read(cls, segments: int, built: DataFrame) -> Filter:
        """From written segments, one partition after the other."""
        sizes, top = np.ones(segments, np.int64), 0
        for r in built.select("segment", "size", "top").collect():
            sizes[r["segment"]], top = r["size"], max(top, r["top"])
        out = cls(sizes, np.zeros(int(sizes.sum()), "<u8"), top)
        for r in built.select("segment", "bits").toLocalIterator():
            start = int(out.starts[r["segment"]])
            out.words[start : start + len(r["bits"]) // 8] = np.frombuffer(r["bits"], "<u8")
        return out

    def _has(self, grams: np.ndarray, at: int, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        out, one, live = np.ones(len(grams), bool), np.uint64(1), slice(None)
        for word, (b0, b1, b2) in _places(grams, at, size):
            mask = (one << b0[live]) | (one << b1[live]) | (one << b2[live])
            found = (self.words[start[live] + word[live]] & mask) == mask
            out[live] = found
            live = np.flatnonzero(out)
        return out

    def has(self, grams: np.ndarray, at: int) -> np.ndarray:
        """Which entries (gram, at) are held."""
        segment = _segment(grams, len(self.sizes))
        return self._has(grams, at, self.starts[segment], self.sizes[segment])

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """None is above the highest level built, however full the filter is."""
        out, live = np.zeros(len(grams), np.int64), np.arange(len(grams))
        segment = _segment(grams, len(self.sizes))
        start, size = self.starts[segment], self.sizes[segment]
        for at in range(1, self.top + 1):
            kept = np.flatnonzero(self._has(grams, at, start, size))
            live, grams, start, size = live[kept], grams[kept], start[kept], size[kept]
            if not len(live):
                break
            out[live] = at
        return out

    def counts(self, grams: np.ndarray) -> np.ndarray:
        unique, where = np.unique(grams, return_inverse=True)
        return count_of(self.levels(unique))[where]

    def error_rate(self, probes: int = 200_000) -> float:
        """How often an n-gram that is not held is found, by trial."""
        return float(self.has(mixed(np.arange(probes, dtype=np.uint64) + _PAIR), 1).mean())


class _Found:
    """The levels of a chunk's n-grams, looked up elsewhere."""

    def __init__(self, grams: np.ndarray, levels: np.ndarray):
        self.grams, first = np.unique(grams, return_index=True)
        self.levels = levels[first]

    def counts(self, grams: np.ndarray) -> np.ndarray:
        return count_of(self.levels)[np.searchsorted(self.grams, grams)]


def log_probabilities(model: Filter | _Found, n: int, v: int, hashes: list[np.ndarray]) -> np.ndarray:
    """log10 of each text's probability."""
    hashes = [np.ascontiguousarray(h) for h in hashes]
    row = np.concatenate(hashes)
    word = model.counts(row)
    starts = np.concatenate([[0], np.cumsum([len(h) for h in hashes])[:-1]])
    before = np.concatenate([[0.0], word[:-1]])
    before[starts] = word[np.concatenate([starts[1:], [len(row)]]) - 1]  # every text ends with the end
    pair = np.minimum(model.counts(np.concatenate([pair_grams(h) for h in hashes])), np.minimum(word, before))
    single = (word + 0.5) / (n + 0.5 * (v + 1))
    return np.add.reduceat(np.log10((pair + PRIOR * single) / (before + PRIOR)), starts)


class _Known(WordHashes):
    """A word's hash and, for frequent words, log10(count + 0.5), not-a-number for others: 16 bytes."""

    kind = np.dtype([("hash", "<u8"), ("log", "<f8")])

    def __init__(self, hot: list[tuple[bytes, int]]):
        super().__init__()
        self.logs = {w: np.float64(math.log10(c + 0.5)).tobytes() for w, c in hot}
        self.other = np.float64(np.nan).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        value = self[word] = super().__missing__(word) + self.logs.get(word, self.other)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, found)), self.kind)


_SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("hot_known", pa.int64()), ("hot_sum", pa.float64()), ("score", pa.float64()),
    ("rest", pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))),
])


def _scores(model, n: int, v: int, known: _Known, row: int, rows: pa.RecordBatch | pa.Table, texts: list[bytes]) -> pa.RecordBatch:
    """Scores of rows that begin with (doc_id, held_out), numbered from ``row``. The model may be made from the texts' hashes."""
    found = [tokens(t) for t in texts]
    values_of = [known.of(ts) for ts in found]
    hashes = [x["hash"] for x in values_of]
    scores = log_probabilities(model(hashes) if callable(model) else model, n, v, hashes)
    out: dict[str, list] = {f.name: [] for f in _SCORED}
    words, times, offsets = [], [], [0]
    for ts, x in zip(found, values_of, strict=True):
        values = x["log"]
        other = np.isnan(values)
        rest = Counter(ts[i] for i in np.flatnonzero(other))
        out["n_tokens"].append(len(ts))
        out["hot_known"].append(len(ts) - int(other.sum()))
        out["hot_sum"].append(float(values[~other].sum()))
        words += rest.keys()
        times += rest.values()
        offsets.append(len(words))
    out["row"] = list(range(row, row + len(texts)))
    out["doc_id"], out["held_out"] = rows.column(0).to_pylist(), rows.column(1).to_pylist()
    out["score"] = scores.tolist()
    kind = _SCORED.field("rest").type
    pairs = pa.StructArray.from_arrays(
        [pa.array(words, pa.binary()), pa.array(times, pa.int64())], fields=list(kind.value_type)
    )
    out["rest"] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs, type=kind)
    return batch(_SCORED, out)


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, n, v, hot = sent.value
        known, row = _Known(hot), TaskContext.get().partitionId() << 40
        for b, texts in _batches(batches, 2):
            yield _scores(model, n, v, known, row, b, texts)
            row += len(texts)

    return run


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text, chunk, row): the chunk is the number of its first row."""
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 40
    for b, _ in _batches(batches, 2):
        b = b.append_column("chunk", pa.array(np.full(b.num_rows, row, np.int64)))
        yield b.append_column("row", pa.array(np.arange(row, row + b.num_rows)))
        row += b.num_rows


def _packed(grams: np.ndarray) -> bytes:
    """Ascending numbers as their differences, first all lowest bytes, then all next ones: the high bytes are zeros."""
    return np.diff(grams, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel().cumsum(dtype=np.uint64)


def _different(hashes: list[np.ndarray], segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different n-grams of texts in order, the segments they are in, and where each segment begins; the end comes last."""
    grams = np.unique(np.concatenate([*hashes, *map(pair_grams, hashes)]))
    present, starts = np.unique(_segment(grams, segments), return_index=True)
    return grams, present, np.append(starts, len(grams))


def _probe(segments: int):
    """(segment, chunk, piece, grams): the different n-grams of the rows of a chunk that are in one batch, by segment.

    Such rows follow each other; the number of the first tells the piece.
    """
    schema = pa.schema([("segment", pa.int32()), ("chunk", pa.int64()), ("piece", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b, texts in _batches(batches, 2):
            chunks, rows = b.column(3).to_numpy(), b.column(4).to_numpy()
            for chunk in np.unique(chunks):
                own = np.flatnonzero(chunks == chunk)
                grams, present, starts = _different([known.of(tokens(texts[i])) for i in own], segments)
                columns = {"segment": present.astype(np.int32), "chunk": np.full(len(present), chunk), "piece": np.full(len(present), rows[own[0]])}
                yield batch(schema, columns | {"grams": [_packed(grams[a:z]) for a, z in zip(starts, starts[1:], strict=False)]})

    return run


def _look_up(top: int):
    """(chunk, piece, segment, levels) from rows ordered by segment, the segment's bits before its n-grams."""
    schema = pa.schema([("chunk", pa.int64()), ("piece", pa.int64()), ("segment", pa.int32()), ("levels", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, model = None, None
        for b in sliced(batches):
            out: dict[str, list] = {f.name: [] for f in schema}
            for segment, chunk, piece, grams, bits in zip(*(b.column(c).to_pylist() for c in ("segment", "chunk", "piece", "grams", "bits")), strict=True):
                if bits is not None:
                    words = np.frombuffer(bits, "<u8")
                    current, model = segment, Filter(np.array([len(words)]), words, top)
                    continue
                wanted = _unpacked(grams)
                levels = model.levels(wanted) if segment == current else np.zeros(len(wanted), np.int64)
                for name, value in (("chunk", chunk), ("piece", piece), ("segment", segment), ("levels", levels.astype(np.uint8).tobytes())):
                    out[name].append(value)
            yield batch(schema, out)

    return run


def _score_chunk(segments: int, sent):
    kept: list[_Known] = []

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        n, v, hot = sent.value
        if not kept:
            kept.append(_Known(hot))
        rows = rows.sort_by("row")
        numbers = rows["row"].to_numpy()
        levels_of = {(r["piece"], r["segment"]): r["levels"] for r in found.select(["piece", "segment", "levels"]).to_pylist()}
        pieces_at = sorted({piece for piece, _ in levels_of})

        def model(hashes: list[np.ndarray]) -> _Found:
            bounds = np.append(np.searchsorted(numbers, pieces_at), len(numbers))
            grams, levels = [], []
            for piece, a, z in zip(pieces_at, bounds, bounds[1:], strict=False):
                some, present, _ = _different([np.ascontiguousarray(h) for h in hashes[a:z]], segments)
                grams.append(some)
                levels += [levels_of[piece, int(s)] for s in present]
            return _Found(np.concatenate(grams), np.frombuffer(b"".join(levels), np.uint8).astype(np.int64))

        return pa.Table.from_batches([_scores(model, n, v, kept[0], int(numbers[0]), rows, texts_as_bytes(rows["text"]))])

    return run


def _score_by_segment(rows: DataFrame, segments: int, built: DataFrame, top: int, sent, schema: str) -> DataFrame:
    """Scores by a filter that is not broadcast: no task holds more than a segment or a chunk."""
    small_batches(rows.sparkSession)
    rows = materialize(rows.mapInArrow(_chunk, "doc_id long, held_out boolean, text string, chunk long, row long"), "chunks")
    probes = rows.mapInArrow(_probe(segments), "segment int, chunk long, piece long, grams binary").withColumn("bits", F.lit(None).cast("binary"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("chunk", "long"), ("piece", "long"), ("grams", "binary"))]
    # Nulls come first: a segment's bits are before its n-grams.
    ordered = built.select("segment", *none, "bits").unionByName(probes).repartition("segment").sortWithinPartitions("segment", "chunk")
    levels = materialize(ordered.mapInArrow(_look_up(top), "chunk long, piece long, segment int, levels binary"), "levels")
    return rows.groupBy("chunk").cogroup(levels.groupBy("chunk")).applyInArrow(_score_chunk(segments, sent), schema)


def _hot_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``: those above a count that a table of counts by size tells."""
    size = F.floor(F.log2("c") * 8)
    left, least = most, None
    for r in counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("size")).collect():
        if r["k"] > left:
            break
        left, least = left - r["k"], r["size"]
    if least is None:
        return []
    return [(bytes(r["token"]), r["c"]) for r in counts.filter(size >= least).collect()]


def segments_for(n: int) -> int:
    return max(1, -(-n // SEGMENT_TOKENS))


def write_segments(counted: DataFrame, entry_bits: float) -> DataFrame:
    """(segment, size, top, bits) of (segment, gram, n) rows that are dealt by segment."""
    schema = "segment int, size long, top long, bits binary"
    return materialize(counted.sortWithinPartitions("segment").mapInArrow(_build(entry_bits), schema), "segments")


def build_segments(train: DataFrame, n: int) -> DataFrame:
    """(segment, size, top, bits), written, over the texts of a one-column table with ``n`` tokens."""
    grams = train.mapInArrow(_count_grams(segments_for(n)), "segment int, gram long, n long")
    counted = grams.repartition("segment").groupBy("segment", "gram").agg(F.sum("n").alias("n"))
    return write_segments(counted, ENTRY_BITS)


def build_filter(train: DataFrame, n: int) -> Filter:
    """The whole filter, for a driver that can hold it."""
    return Filter.read(segments_for(n), build_segments(train, n))


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), held_out(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    train = rows.filter("NOT held_out").select("text")
    counts = materialize(
        train.mapInArrow(_count_words, "token binary, n long").groupBy("token").agg(F.sum("n").alias("c")), "word-counts"
    )
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = total["n"], total["v"]
    built, hot = build_segments(train, n), _hot_words(counts, HOT_WORDS)
    send = docs.sparkSession.sparkContext.broadcast
    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_sum double, score double,"
        " rest array<struct<token: binary, n: long>>"
    )
    filled = built.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("words"), F.max("top").alias("top")).first()
    if filled["words"] * 8 <= BROADCAST_BYTES:
        scored = rows.mapInArrow(_score(send((Filter.read(segments_for(n), built), n, v, hot))), schema)
    else:
        scored = _score_by_segment(rows, segments_for(n), built, filled["top"], send((n, v, hot)), schema)
    scored = materialize(scored, "scored")
    rest = scored.select("row", F.explode_outer("rest").alias("w")).filter("w IS NOT NULL").select("row", "w.*")
    c = F.coalesce("c", F.lit(0))
    per_row = (
        rest.join(counts, "token", "left")
        .groupBy("row")
        .agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("rest_sum"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rest_known"))
    )
    whole = math.log10(n + 0.5 * (v + 1))
    return scored.drop("rest").join(per_row, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("hot_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("hot_sum") + F.coalesce("rest_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        "score",
    )
