"""Removal of long repeats with sharded suffix arrays.

Every byte goes that lies in a string of ``LENGTH`` bytes which also starts
elsewhere, in the same document or another. A window is such a string's place.

Shards. Each window names an anchor: the place of its least 48-byte hash, the
leftmost of equal ones. Equal windows name equal anchors, so windows that share an
anchor hash are all that need comparing; those of a document are consecutive and
together make a snippet. Anchors are counted; a Bloom filter of those that occur
again (at most ``MAX_SEGMENTS`` mebibytes; beyond that it only lets more through)
is broadcast, and only their snippets are shuffled, equal ones once. Anchors are
dealt to shards of about ``SHARD_BYTES``.

In a shard, a suffix array is refined by doubling after Larsson and Sadakane: only
groups that are still unsorted are sorted again, by the ranks one length on, until
``LENGTH`` bytes are in order. Kasai's rule gives the common prefixes of
neighbouring windows, for all snippets of the shard in step. Windows whose common
prefix with a neighbour is ``LENGTH`` or more occur again.

An anchor with more snippets than a shard takes is dealt to several shards. Each
of them hands on its windows' fingerprints as sorted runs, cut into ranges; per
range the runs are merged, and every run is looked up in the merged run by binary
search: a window found twice occurs again.

A null text is empty. Texts under ``LENGTH`` bytes have no windows and stay whole.
Rows that repeat an id and its text repeat each other's windows. Null ids are told
apart by their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm import ngrams
from faultloom.llm.common import batch, mixed, pieces, sliced, texts_as_bytes
from faultloom.session import materialize

LENGTH, GRAM = 200, 48
#: Bytes of text hashed at once, of a shard, snippets of an anchor in a shard, fingerprints of a merge.
TEXT_BYTES, SHARD_BYTES, SNIPPETS, MERGED = 1 << 20, 1 << 21, 8_000, 500_000
LONG_TEXT, MAX_SEGMENTS, REMEMBERED = 8 << 20, 64, 100_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 48 bytes from each place on: a polynomial, joined from halves."""
    h, n, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    kept = {}
    while n < 32:
        h = h[: len(h) - n] * power + h[n:]
        power, n = np.multiply(power, power), n * 2
        kept[n] = h, power
    sixteen, power16 = kept[16]
    h = h[: len(data) - GRAM + 1] * power16 + sixteen[32 : 32 + len(data) - GRAM + 1]
    return mixed(h)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys, from running minima of blocks both ways."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, last window) of each run of windows that share an anchor.

    ``ends`` are where texts end in ``data``, at most 16 MiB; no window crosses one.
    """
    if len(data) < LENGTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = gram_hashes(data)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = _least(keys, LENGTH - GRAM + 1)
    end = np.repeat(ends, np.diff(ends, prepend=0))[: len(least)]
    windows = np.flatnonzero(np.arange(len(least)) + LENGTH <= end)
    place = (least[windows] & _PLACE).astype(np.int64)
    if not len(windows):
        return np.empty(0, np.uint64), windows, windows
    new = np.flatnonzero((place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new - 1, [len(windows) - 1]])
    return hashes[place[first]], windows[first], windows[last]


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, ends, owner, shift): texts end to end; a very long one in parts that share LENGTH - 1 bytes."""
    for lo, hi in pieces(texts, TEXT_BYTES):
        if hi - lo > 1 or len(texts[lo]) <= LONG_TEXT:
            ends = np.cumsum([len(t) for t in texts[lo:hi]])
            yield np.frombuffer(b"".join(texts[lo:hi]), np.uint8), ends, np.arange(lo, hi), np.concatenate([[0], ends[:-1]])
            continue
        text = np.frombuffer(texts[lo], np.uint8)
        for a in range(0, len(text), LONG_TEXT):
            part = text[a : a + LONG_TEXT + LENGTH - 1]
            yield part, np.array([len(part)]), np.array([lo]), np.array([-a])


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, found, size = pa.schema([("gram", pa.int64()), ("n", pa.int64())]), [], 0

    def counted() -> pa.RecordBatch:
        grams, n = np.unique(np.concatenate(found), return_counts=True)
        return batch(schema, {"gram": grams.view(np.int64), "n": n})

    for b in sliced(batches):
        for data, ends, _, _ in _chunks(texts_as_bytes(b.column(0))):
            found.append(anchors(data, ends)[0])
            size += len(found[-1])
            if size > 500_000:
                yield counted()
                found, size = [], 0
    if found:
        yield counted()


_SNIPPET = pa.schema([
    ("anchor", pa.int64()), ("snippet", pa.binary()), ("doc_id", pa.int64()), ("version", pa.int64()),
    ("place", pa.int64()), ("bytes", pa.binary()),
])


def _snippets(sent):
    """Snippets of anchors that the filter knows; the bytes only where this task has not just sent them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, told = sent.value, set()
        for b in sliced(batches):
            ids, versions, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), texts_as_bytes(b.column(2))
            for data, ends, owner, shift in _chunks(texts):
                grams, first, last = anchors(data, ends)
                live = np.flatnonzero(again.has(grams, 1))
                raw, out = data.tobytes(), {f.name: [] for f in _SNIPPET}
                text = np.searchsorted(ends, first[live], side="right")
                for k, t in zip(live.tolist(), text.tolist(), strict=True):
                    lo, hi = int(first[k]), int(last[k]) + LENGTH
                    snippet = raw[lo:hi]
                    digest = xxhash.xxh3_128_digest(snippet)
                    if len(told) > REMEMBERED:
                        told.clear()
                    out["bytes"].append(None if digest in told else snippet)
                    told.add(digest)
                    out["snippet"].append(digest)
                    out["doc_id"].append(ids[owner[t]])
                    out["version"].append(versions[owner[t]])
                    out["place"].append(lo - int(shift[t]))
                out["anchor"] = grams[live].view(np.int64)
                yield batch(_SNIPPET, out)

    return run


def _eights(text: np.ndarray, n: int) -> np.ndarray:
    """Eight bytes from each place on as a number, in the order of the bytes."""
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | text[j : j + n]
    return out


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places of suffixes in the order of their first ``depth`` bytes or more; equal ones by place.

    ``text`` is followed by zeros. Larsson and Sadakane: a suffix's rank is its
    group's first place in the order; each round sorts the groups of two and more
    by the rank as many bytes on as are in order already.
    """
    n = len(text)
    key = _eights(np.concatenate([text, np.zeros(8, np.uint8)]), n)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    start = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    done = 8
    while done < depth:
        alone = start & np.concatenate([start[1:], [True]])
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        suffix = order[at]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + done, n)] + 1
        by = np.argsort(key, kind="stable")
        order[at], key = suffix[by], key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start[at] = new
        rank[order[at]] = np.maximum.accumulate(np.where(new, at, 0))
        done *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each window, the bytes (up to LENGTH) it shares with the window before it in the order.

    Snippet ``k`` has windows at ``starts[k]`` and the ``counts[k] - 1`` places
    behind. Kasai: a window shares one byte less, or more, than the window one place
    earlier did, if the latter's neighbour has a window one place on that comes
    earlier, too. All snippets go through their windows in step.
    """
    n = len(text)
    eights = _eights(np.concatenate([text, np.zeros(LENGTH + 16, np.uint8)]), n + LENGTH + 8)
    is_window = np.zeros(n + 1, bool)
    is_window[np.repeat(starts, counts) + _ramp(counts)] = True
    windows = order[is_window[order]]
    before, at = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
    before[windows[1:]] = windows[:-1]
    at[windows] = np.arange(len(windows))
    shared = np.zeros(n, np.int64)
    by_count = np.argsort(-counts, kind="stable")
    lanes, ends = starts[by_count], counts[by_count]
    h = np.zeros(len(lanes), np.int64)
    for t in range(int(counts.max(initial=0))):
        m = int(np.searchsorted(-ends, -t, side="left"))  # snippets with a window here
        i = lanes[:m] + t
        j = before[i]
        if t:
            old = before[i - 1]
            follows = (old >= 0) & is_window[old + 1] & (at[old + 1] < at[i])
            h = np.where(follows, np.maximum(h[:m] - 1, 0), 0)
        live = np.flatnonzero(j >= 0)
        h[j < 0] = 0
        while len(live):
            differ = eights[i[live] + h[live]] ^ eights[j[live] + h[live]]
            same = differ == 0
            for bits in range(8, 64, 8):
                h[live] += ~same & (differ >> np.uint64(64 - bits) == 0)
            live = live[same]
            h[live] += 8
            live = live[h[live] < LENGTH]
        h = np.minimum(h, LENGTH)
        shared[i] = h
    return shared


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def repeated_windows(snippets: list[bytes]) -> list[np.ndarray]:
    """Per snippet, which of its windows occur again in these snippets."""
    text = np.frombuffer(b"".join(snippets), np.uint8)
    lengths = np.array([len(s) for s in snippets])
    starts, counts = np.cumsum(lengths) - lengths, lengths - LENGTH + 1
    order = suffix_array(text)
    shared = common_prefixes(text, order, starts, counts)
    is_window = np.zeros(len(text), bool)
    is_window[np.repeat(starts, counts) + _ramp(counts)] = True
    windows = order[is_window[order]]
    with_before = shared[windows] >= LENGTH
    found = np.zeros(len(text), bool)
    found[windows] = with_before | np.concatenate([with_before[1:], [False]])
    return [found[a : a + c] for a, c in zip(starts, counts, strict=True)]


def _runs(flags: np.ndarray) -> np.ndarray:
    """[first, last + 1) of runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges.reshape(-1, 2).astype(np.int32)


def _fingerprints(snippet: bytes) -> np.ndarray:
    """A hash of each window."""
    h = gram_hashes(np.frombuffer(snippet, np.uint8))
    n = len(snippet) - LENGTH + 1
    out = h[:n]
    for shift in (GRAM, 2 * GRAM, 3 * GRAM, LENGTH - GRAM):
        out = mixed(out * _BASE + h[shift : shift + n])
    return out


_SHARD = pa.schema([
    ("anchor", pa.int64()), ("snippet", pa.binary()), ("spans", pa.binary()),
    ("range", pa.int32()), ("keys", pa.binary()), ("places", pa.binary()),
])
_SHARD_DDL = "anchor long, snippet binary, spans binary, `range` int, keys binary, places binary"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of snippets from rows ordered by anchor and salt; runs for anchors dealt to several shards."""
    shard: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        out: dict[str, list] = {f.name: [] for f in _SHARD}

        def put(anchor, snippet, spans=None, range_=None, keys=None, places=None):
            for name, value in zip(out, (anchor, snippet, spans, range_, keys, places), strict=True):
                out[name].append(value)

        # A snippet that has no other of its anchor beside it needs no array.
        several = [k for k, r in enumerate(shard) if any(0 <= o < len(shard) and shard[o][0] == r[0] for o in (k - 1, k + 1))]
        found = dict(zip(several, repeated_windows([shard[k][2] for k in several]), strict=True)) if several else {}
        for k, (anchor, snippet, data, n, _, ranges) in enumerate(shard):
            flags = np.ones(len(data) - LENGTH + 1, bool) if n > 1 else found.get(k)
            if flags is not None and flags.any():
                put(anchor, snippet, _runs(flags).tobytes())
            if ranges > 1:
                keys = _fingerprints(data)
                order = np.argsort(keys, kind="stable").astype(np.int32)
                bounds = [(r << 64) // ranges for r in range(1, ranges)]
                cuts = np.searchsorted(keys[order], np.array(bounds, np.uint64))
                for r, part in enumerate(np.split(order, cuts)):
                    if len(part):
                        put(anchor, snippet, None, r, keys[part].tobytes(), part.tobytes())
        shard.clear()
        return batch(_SHARD, out)

    last = None
    for b in batches:
        for row in zip(*(b.column(n).to_pylist() for n in ("anchor", "snippet", "bytes", "n", "salt", "ranges")), strict=True):
            if size >= SHARD_BYTES and (row[0], row[4]) != last:
                yield done()
                size = 0
            shard.append(row)
            size += len(row[2])
            last = row[0], row[4]
    if shard:
        yield done()


def _merge(_key: tuple, runs: pa.Table) -> pa.Table:
    """Windows of one range of an anchor's fingerprints that occur again, found by binary search."""
    keys = [np.frombuffer(k, np.uint64) for k in runs.column("keys").to_pylist()]
    places = [np.frombuffer(p, np.int32) for p in runs.column("places").to_pylist()]
    anchor, snippet = runs.column("anchor").to_pylist(), runs.column("snippet").to_pylist()
    merged = np.sort(np.concatenate(keys))
    out: dict[str, list] = {"anchor": [], "snippet": [], "spans": []}
    for a, s, k, p in zip(anchor, snippet, keys, places, strict=True):
        twice = np.searchsorted(merged, k, side="right") - np.searchsorted(merged, k, side="left") > 1
        if twice.any():
            flags = np.zeros(p.max() + 1, bool)
            flags[p[twice]] = True
            out["anchor"].append(a)
            out["snippet"].append(s)
            out["spans"].append(_runs(flags).tobytes())
    return pa.table({"anchor": pa.array(out["anchor"], pa.int64()), "snippet": pa.array(out["snippet"], pa.binary()), "spans": pa.array(out["spans"], pa.binary())})


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
    ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64())),
])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        out: dict[str, list] = {f.name: [] for f in _RESULT}
        for doc_id, text, found in zip(b.column(0).to_pylist(), texts_as_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
            spans = np.empty((0, 2), np.int64)
            if found:
                parts = [np.frombuffer(f["spans"], np.int32).reshape(-1, 2).astype(np.int64) + f["place"] for f in found]
                spans = merged_spans(np.concatenate(parts) + [0, LENGTH - 1])
            kept, at = hashlib.sha256(), 0
            for a, e in spans.tolist():
                kept.update(text[at:a])
                at = e
            kept.update(text[at:])
            values = (doc_id, len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(), spans.ravel().tolist())
            for name, value in zip(out, values, strict=True):
                out[name].append(value)
        yield batch(_RESULT, out)


def merged_spans(spans: np.ndarray) -> np.ndarray:
    """Spans that meet or overlap as one, in order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.column_stack([spans[new, 0], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(spans) - 1]])]])


def _repeated_anchors(rows: DataFrame) -> ngrams.Filter:
    counts = rows.select("text").mapInArrow(_count_anchors, "gram long, n long")
    again = materialize(counts.groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram"), "anchors")
    n = again.count()
    segments, bits = min(MAX_SEGMENTS, max(1, -(-n * 16 >> 23))), min(16, (MAX_SEGMENTS << 23) / max(1, n))
    # The same place as the filter's own: the upper bits of the hash, unsigned, by the number of segments.
    segment = F.shiftrightunsigned(F.shiftrightunsigned("gram", 32) * segments, 32).cast("int").alias("segment")
    dealt = again.select(segment, "gram", F.lit(1).cast("long").alias("n")).repartition("segment")
    return ngrams.Filter.read(segments, ngrams.write_segments(dealt, bits))


def _spans(found: DataFrame) -> DataFrame:
    """(anchor, snippet, spans): the windows of snippets that occur again, a snippet maybe in several rows."""
    alike = found.groupBy("anchor", "snippet").agg(F.first("bytes", ignorenulls=True).alias("bytes"), F.count(F.lit(1)).alias("n"))
    alike = materialize(alike, "snippets")
    many = alike.groupBy("anchor").agg(F.count(F.lit(1)).alias("k"), F.sum(F.octet_length("bytes") - LENGTH + 1).alias("windows"))
    many = many.filter(F.col("k") > SNIPPETS)
    salts, ranges = F.ceil(F.col("k") / SNIPPETS), F.greatest(F.lit(2), F.ceil(F.col("windows") / MERGED))
    many = materialize(many.select("anchor", salts.cast("int").alias("salts"), ranges.cast("int").alias("ranges")), "many-snippets")
    dealt = alike.join(many, "anchor", "left").select(
        "anchor", "snippet", "bytes", "n",
        F.pmod(F.xxhash64("snippet"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"),
        F.coalesce("ranges", F.lit(1)).alias("ranges"),
    )
    shards = dealt.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "snippet").mapInArrow(_shards, _SHARD_DDL)
    shards = materialize(shards, "shards")
    inside = shards.filter("spans IS NOT NULL").select("anchor", "snippet", "spans")
    runs = shards.filter("keys IS NOT NULL").select("anchor", "range", "snippet", "keys", "places")
    across = runs.groupBy("anchor", "range").applyInArrow(_merge, "anchor long, snippet binary, spans binary")
    return inside.union(across)


def _versioned(docs: DataFrame, id: str, text: str) -> DataFrame:
    body: Column = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("text"))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row; spans as start, end, start, ..."""
    rows = _versioned(docs, id, text)
    sent = docs.sparkSession.sparkContext.broadcast(_repeated_anchors(rows))
    ddl = "anchor long, snippet binary, doc_id long, version long, place long, bytes binary"
    found = materialize(rows.mapInArrow(_snippets(sent), ddl), "found-snippets")
    spans = materialize(_spans(found), "snippet-spans")
    places = found.select("anchor", "snippet", "doc_id", "version", "place").join(spans, ["anchor", "snippet"])
    # A set: as many as the text has anchors, at most, however often its row is repeated.
    per_doc = places.groupBy("doc_id", "version").agg(F.collect_set(F.struct("place", "spans")).alias("found"))
    per_doc = materialize(per_doc.withColumnsRenamed({"doc_id": "_id", "version": "_version"}), "document-spans")
    same = rows["doc_id"].eqNullSafe(per_doc["_id"]) & (rows["version"] == per_doc["_version"])
    joined = rows.join(per_doc, same, "left").select("doc_id", "text", "found")
    return joined.mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    )
