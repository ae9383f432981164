"""Collocations from weighted acyclic automata of word n-grams.

1. A shard is some megabytes of texts of one language. Its n-grams of one to three
   words, with their counts, are put in order and fed to a builder, which makes an
   automaton: arcs are words, a path is an n-gram, its weight the count. Nodes
   are frozen as soon as the order has left them, and equal ones (the same last
   words with the same counts) are one node, found in a register.
2. The order of n-grams is cut into prefix ranges of about equal content. A shard
   builds one automaton for each range, and sends that to it. There the automata
   of all shards are united and their weights summed; only n-grams that are
   frequent enough are kept, as the automaton of the range.
3. Candidates are read from these automata. The parts that their cuts leave are
   made an automaton again, in the range where each belongs, and are composed with
   the counts: both are walked together, and the weights are the parts' counts.
4. Scores, the longer phrases that make a candidate drop, and ranks are Spark SQL,
   in decimals of 38 digits.

The cuts are read off a bounded sample (about ``SAMPLE`` texts of a language of at
most ``SAMPLE_BYTES``, and their first ``SLICE`` words); they decide where an n-gram is counted, never whether. They
may fall inside a frequent word's or a frequent pair's n-grams, so that no range
is hot. Beyond ``CUTS`` ranges of a language, each is dealt to several tasks by a
hash of the n-gram.

Words are compared as bytes, never by hashes. A null text has no words, a null
language is ``und``. Ids are not looked at; repeated rows count each time. A text of
any length is counted whole: n-grams that lie across two slices of a shard belong
to the first.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.llm.common import batch, join_facts, mixed, sliced, texts_as_bytes
from faultloom.session import materialize

MIN_COUNT, SHARE, TOP = 10, 50, 2_000
#: Bytes of texts of a shard, words of a slice of it, bytes of texts whose n-grams make a range.
SHARD_BYTES, SLICE, RANGE_BYTES = 3 << 20, 2_000_000, 6 << 20
#: Sampled texts of a language, their size, ranges of a language, n-grams that a builder takes at once.
SAMPLE, SAMPLE_BYTES, CUTS, RUN = 600, 1 << 16, 4_096, 1 << 18

# The marks at which texts are cut into pieces.
MARKS = b".,;:!?\n\x0b\x0c\r"
_TO_DOTS = bytes.maketrans(MARKS, b"." * len(MARKS))
_BITS = 21
_LOW = np.uint64((1 << _BITS) - 1)
_K = np.uint64(0x9E3779B97F4A7C15)


class Ngrams:
    """N-grams in order: for each up to three places, 1 + the number of a word, 0 for none, and a weight."""

    def __init__(self, words: list[bytes], places: np.ndarray, weights: np.ndarray):
        self.words, self.places, self.weights = words, places, weights

    def __len__(self) -> int:
        return len(self.weights)

    def part(self, chosen: slice | np.ndarray) -> Ngrams:
        """Some of them, with the words they use."""
        places, weights = self.places[:, chosen], self.weights[chosen]
        used = np.unique(places)
        used = used[used > 0]
        number = np.zeros(len(self.words) + 1, np.int64)
        number[used] = np.arange(1, len(used) + 1)
        return Ngrams([self.words[i - 1] for i in used.tolist()], number[places], weights)

    def phrases(self) -> list[tuple[bytes, ...]]:
        names = [b"", *self.words]
        return [tuple(names[i] for i in t if i) for t in self.places.T.tolist()]


def _summed(words: list[bytes], places: np.ndarray, weights: np.ndarray) -> Ngrams:
    """N-grams in any order, put in order, equal ones as one."""
    if not places.shape[1]:
        return Ngrams(words, places.astype(np.int64), weights)
    one, two, three = places.astype(np.uint64)
    if len(words) <= int(_LOW) - 1:
        key = (one << np.uint64(2 * _BITS)) | (two << np.uint64(_BITS)) | three
    else:
        _, pair = np.unique((one << np.uint64(32)) | two, return_inverse=True)
        key = (pair.astype(np.uint64) << np.uint64(32)) | three
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return Ngrams(words, places[:, order[first]].astype(np.int64), np.add.reduceat(weights[order], first))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one span after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Builder:
    """Makes an automaton from n-grams that come in order, some at a time."""

    def __init__(self):
        # Node 0 has no arcs.
        self.register: dict[int, int] = {}
        self.size, self.arc, self.arc_weight = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pairs: list[tuple] = []
        self.firsts: list[tuple] = []

    def _new(self, arcs: np.ndarray, weights: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        taken = _spans(begins, sizes)
        made = len(self.size) + np.arange(len(sizes))
        self.size = np.concatenate([self.size, sizes])
        self.arc, self.arc_weight = np.concatenate([self.arc, arcs[taken]]), np.concatenate([self.arc_weight, weights[taken]])
        return made

    def _frozen(self, arcs: np.ndarray, weights: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The node of each group of last words: one that is in the register, or a new one.

        Groups are looked up by a digest and then compared word by word; a group that
        only shares its digest with another is a node of its own.
        """
        digest = np.add.reduceat(mixed(arcs.astype(np.uint64) * _K + mixed(weights.astype(np.uint64))), begins)
        digest, first, where = np.unique(mixed(digest + sizes.astype(np.uint64)), return_index=True, return_inverse=True)
        keys = digest.tolist()
        nodes = np.array([self.register.get(k, -1) for k in keys], np.int64)
        unknown = np.flatnonzero(nodes < 0)
        nodes[unknown] = self._new(arcs, weights, begins[first[unknown]], sizes[first[unknown]])
        self.register.update((keys[k], int(nodes[k])) for k in unknown.tolist())
        found = nodes[where]
        other = self.size[found] != sizes
        starts = (np.cumsum(self.size) - self.size)[found]
        own, theirs = _spans(begins, sizes), _spans(starts, np.where(other, 0, sizes))
        own = own[np.repeat(~other, sizes)]
        differs = (arcs[own] != self.arc[theirs]) | (weights[own] != self.arc_weight[theirs])
        other[np.repeat(np.arange(len(sizes)), np.where(other, 0, sizes))[differs]] = True
        found[other] = self._new(arcs, weights, begins[other], sizes[other])
        return found

    def add(self, places: np.ndarray, weights: np.ndarray) -> None:
        """Further n-grams. A run never ends between two that share their first two words."""
        one, two, three = places
        if not len(one):
            return
        new_first = np.concatenate([[True], one[1:] != one[:-1]])
        start = np.flatnonzero(new_first)
        self.firsts.append((one[start], np.where(two[start] == 0, weights[start], 0)))
        new_pair = (two > 0) & (new_first | np.concatenate([[True], two[1:] != two[:-1]]))
        start = np.flatnonzero(new_pair)
        last = three > 0
        nodes = np.zeros(len(start), np.int64)
        if last.any():
            sizes = np.bincount(np.cumsum(new_pair)[last] - 1, minlength=len(start))
            full = np.flatnonzero(sizes)
            nodes[full] = self._frozen(three[last], weights[last], (np.cumsum(sizes) - sizes)[full], sizes[full])
        self.pairs.append((one[start], two[start], np.where(three[start] == 0, weights[start], 0), nodes))

    def done(self, words: list[bytes]) -> Automaton:
        none = [np.empty(0, np.int64)]
        first, first_weight = (np.concatenate(none + [x[k] for x in self.firsts]) for k in range(2))
        owner, pair, pair_weight, node = (np.concatenate(none + [x[k] for x in self.pairs]) for k in range(4))
        # A first word may go on in the next run.
        keep = np.concatenate([[True], first[1:] != first[:-1]]) if len(first) else np.empty(0, bool)
        first, first_weight = first[keep], first_weight[keep]
        count = np.bincount(np.searchsorted(first, owner), minlength=len(first)) if len(first) else first
        arrays = first, first_weight, count, pair, pair_weight, node
        return Automaton(words, *arrays, self.size, self.arc, self.arc_weight)


class Automaton:
    """The start's arcs are first words, each with a weight and arcs for second words; those lead to shared nodes."""

    def __init__(self, words: list[bytes], *arrays: np.ndarray):
        self.words, self.arrays = words, arrays
        self.first, self.first_weight, self.count, self.pair, self.pair_weight, self.node, self.size, self.arc, self.arc_weight = arrays

    @classmethod
    def of(cls, ngrams: Ngrams) -> Automaton:
        builder, places, lo = Builder(), ngrams.places, 0
        while lo < len(ngrams):
            hi = min(lo + RUN, len(ngrams))
            while hi < len(ngrams) and places[1, hi] and (places[:2, hi] == places[:2, hi - 1]).all():
                hi += 1
            builder.add(places[:, lo:hi], ngrams.weights[lo:hi])
            lo = hi
        return builder.done(ngrams.words)

    def to_bytes(self) -> bytes:
        """Each array with the bytes its largest number needs; words hold no space."""
        out = []
        for x in self.arrays:
            kind = np.min_scalar_type(int(x.max(initial=0)))
            out += [struct.pack("<BQ", kind.itemsize, len(x)), x.astype(kind).tobytes()]
        return b"".join([*out, b" ".join(self.words)])

    @classmethod
    def from_bytes(cls, data: bytes) -> Automaton:
        at, arrays = 0, []
        for _ in range(9):
            width, size = struct.unpack_from("<BQ", data, at)
            arrays.append(np.frombuffer(data, f"<u{width}", size, at + 9).astype(np.int64))
            at += 9 + width * size
        words = bytes(data[at:])
        return cls(words.split(b" ") if words else [], *arrays)

    def ngrams(self) -> Ngrams:
        """All paths with a weight; not in order."""
        owner = np.repeat(self.first, self.count)
        size = self.size[self.node]
        starts = (np.cumsum(self.size) - self.size)[self.node]
        arc = _spans(starts, size)
        zero, nought = np.zeros_like(self.first), np.zeros_like(owner)
        places = np.concatenate([
            np.stack([self.first, zero, zero]), np.stack([owner, self.pair, nought]),
            np.stack([np.repeat(owner, size), np.repeat(self.pair, size), self.arc[arc]]),
        ], axis=1)
        weights = np.concatenate([self.first_weight, self.pair_weight, self.arc_weight[arc]])
        kept = weights > 0
        return Ngrams(self.words, places[:, kept], weights[kept])

    def compose(self, asked: Ngrams) -> np.ndarray:
        """The weight of each n-gram asked for, 0 without a path: both are walked word by word."""
        number = {w: i + 1 for i, w in enumerate(self.words)}
        label = np.array([0, *(number.get(w, -1) for w in asked.words)], np.int64)
        one, two, three = label[asked.places]
        out = np.zeros(len(asked), np.int64)
        if not len(self.first):
            return out
        at = np.searchsorted(self.first, one).clip(max=len(self.first) - 1)
        live = self.first[at] == one
        ends = live & (two == 0)
        out[ends] = self.first_weight[at[ends]]
        live &= two > 0
        if not len(self.pair):
            return out
        keys = (np.repeat(np.arange(len(self.first)), self.count) << 32) | self.pair
        wanted = (at << 32) | np.maximum(two, 0)
        at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
        live &= keys[at] == wanted
        ends = live & (three == 0)
        out[ends] = self.pair_weight[at[ends]]
        live &= three > 0
        if len(self.arc):
            keys = (np.repeat(np.arange(len(self.size)), self.size) << 32) | self.arc
            wanted = (self.node[at] << 32) | np.maximum(three, 0)
            at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
            live &= keys[at] == wanted
            out[live] = self.arc_weight[at[live]]
        return out


def united(automata: list[Automaton]) -> Ngrams:
    """The n-grams of all, weights summed, over the union of their words."""
    found = [a.ngrams() for a in automata]
    labels = pa.array([w for f in found for w in f.words], pa.binary()).dictionary_encode()
    names = labels.dictionary
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    codes, at, places = rank[labels.indices.to_numpy()] if len(order) else rank, 0, []
    for f in found:
        number = np.concatenate([[0], codes[at : at + len(f.words)]])
        places.append(number[f.places])
        at += len(f.words)
    return _summed(names.take(pa.array(order)).to_pylist(), np.concatenate(places, axis=1), np.concatenate([f.weights for f in found]))


def words_and_marks(texts: list[bytes]) -> list[bytes]:
    """The words of texts in a row, a dot for every mark and between texts."""
    return b" . ".join(t.lower().translate(_TO_DOTS).replace(b".", b" . ") for t in texts).split()


def counted(found: list[bytes]) -> Iterator[Ngrams]:
    """The n-grams of words and marks, slice by slice."""
    for lo in range(0, len(found), SLICE):
        labels = pa.array(found[lo : lo + SLICE + 2], pa.binary()).dictionary_encode()
        order = pc.sort_indices(labels.dictionary).to_numpy()
        words = labels.dictionary.take(pa.array(order)).to_pylist()
        rank = np.empty(len(order), np.uint64)
        rank[order] = np.arange(1, len(order) + 1)
        dot = bisect_left(words, b".")
        if dot < len(words) and words[dot] == b".":
            rank[order[dot]] = 0
        t = np.concatenate([rank[labels.indices.to_numpy()], np.zeros(2, np.uint64)])
        n = min(SLICE, len(found) - lo)
        one, two, three = t[:n], t[1 : n + 1], t[2 : n + 2]
        single = one[one > 0] << np.uint64(2 * _BITS)
        is_pair = (one > 0) & (two > 0)
        pair = (one[is_pair] << np.uint64(2 * _BITS)) | (two[is_pair] << np.uint64(_BITS))
        whole = pair[three[is_pair] > 0] | three[is_pair & (three > 0)]
        keys = np.sort(np.concatenate([single, pair, whole]))
        if not len(keys):
            continue
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        weights = np.diff(np.concatenate([first, [len(keys)]]))
        keys = keys[first]
        places = np.stack([keys >> np.uint64(2 * _BITS), (keys >> np.uint64(_BITS)) & _LOW, keys & _LOW]).astype(np.int64)
        yield Ngrams(words, places, weights)


class Ranges:
    """Where n-grams of a language are counted: cuts in their order, and the tasks of each range."""

    def __init__(self, cuts: list[tuple[bytes, ...]], tasks: int = 1):
        self.cuts, self.tasks = cuts, tasks

    @classmethod
    def over(cls, sample: list[bytes], ranges: int) -> Ranges:
        some = next(counted(words_and_marks(sample)), Ngrams([], np.zeros((3, 0), np.int64), np.empty(0, np.int64)))
        kept = max(1, min(ranges, CUTS, len(some)))
        cuts = some.part(np.array([k * len(some) // kept for k in range(1, kept)], np.int64)).phrases()
        return cls(cuts, -(-ranges // kept) if ranges > CUTS else 1)

    def _task(self, words: list[bytes], places: np.ndarray) -> np.ndarray:
        hashes = np.array([0, *(xxhash.xxh64_intdigest(w) for w in words)], np.uint64)[places]
        return (mixed(mixed(mixed(hashes[0]) + hashes[1] * _K) + hashes[2]) % np.uint64(self.tasks)).astype(np.int64)

    def split(self, ngrams: Ngrams) -> Iterator[tuple[int, Ngrams]]:
        """(range, its n-grams) of those that have any."""
        if not len(ngrams):
            return
        words, (one, two, three) = ngrams.words, ngrams.places
        begins = [0]
        for cut in self.cuts:
            lo, hi = begins[-1], len(ngrams)
            for place, word in zip((one, two, three), cut, strict=False):
                at = bisect_left(words, word) + 1
                lo, hi = lo + np.searchsorted(place[lo:hi], at, "left"), lo + np.searchsorted(place[lo:hi], at, "right")
                if lo == hi or words[at - 1 : at] != [word]:
                    hi = lo
                    break
            begins.append(int(lo))
        for k, (lo, hi) in enumerate(zip(begins, [*begins[1:], len(ngrams)], strict=True)):
            if lo == hi:
                continue
            if self.tasks == 1:
                yield k, ngrams.part(slice(lo, hi))
                continue
            task = self._task(words, ngrams.places[:, lo:hi])
            for t in np.unique(task).tolist():
                yield k * self.tasks + t, ngrams.part(lo + np.flatnonzero(task == t))

    def of(self, phrase: tuple[bytes, ...]) -> int:
        k = bisect_right(self.cuts, phrase)
        if self.tasks == 1:
            return k
        places = np.array([[i + 1 if i < len(phrase) else 0] for i in range(3)])
        return k * self.tasks + int(self._task(list(phrase), places)[0])


_PART = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("automaton", pa.binary())])


def _build(sent):
    """Automata of the shards of a task, one for each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def shard(lang: str) -> Iterator[pa.RecordBatch]:
            texts, _ = waiting.pop(lang), sizes.pop(lang)
            ranges = sent.value.get(lang) or Ranges([])
            for ngrams in counted(words_and_marks(texts)):
                for part, own in ranges.split(ngrams):
                    yield batch(_PART, {"lang": [lang], "part": [part], "automaton": [Automaton.of(own).to_bytes()]})

        for rows in sliced(batches):
            for lang, text in zip(rows.column(0).to_pylist(), texts_as_bytes(rows.column(1)), strict=True):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= SHARD_BYTES:
                    yield from shard(lang)
                elif sum(sizes.values()) >= 2 * SHARD_BYTES:
                    yield from shard(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from shard(lang)

    return run


def _unite(min_count: int):
    """One automaton of the n-grams that are frequent, and the number of words, for a range."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ngrams = united([Automaton.from_bytes(b) for b in table.column("automaton").to_pylist()])
        words = int(ngrams.weights[ngrams.places[1] == 0].sum())
        data = Automaton.of(ngrams.part(ngrams.weights >= min_count)).to_bytes()
        return pa.table({"lang": [key[0].as_py()], "part": [key[1].as_py()], "automaton": pa.array([data], pa.binary()), "n": [words]})

    return run


_CUT = pa.schema([
    ("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("a", pa.int64()), ("cut", pa.int32()),
    ("is_left", pa.bool_()), ("part", pa.int64()), ("piece", pa.string()),
])


def _cut(sent):
    """A row for both pieces of each cut of each candidate, with the range where the piece is counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for lang, data in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                ngrams = Automaton.from_bytes(data).ngrams()
                ranges = sent.value.get(lang) or Ranges([])
                ngrams = ngrams.part(ngrams.places[1] > 0)
                phrases, weights = ngrams.phrases(), ngrams.weights.tolist()
                for lo in range(0, len(phrases), 10_000):
                    out: dict[str, list] = {f.name: [] for f in _CUT}
                    for words, a in zip(phrases[lo : lo + 10_000], weights[lo : lo + 10_000], strict=True):
                        phrase = b" ".join(words).decode()
                        for k in range(1, len(words)):
                            for is_left, piece in ((True, words[:k]), (False, words[k:])):
                                row = lang, phrase, len(words), a, k, is_left, ranges.of(piece), b" ".join(piece).decode()
                                for f, value in zip(out, row, strict=True):
                                    out[f].append(value)
                    yield batch(_CUT, out)

    return run


def _look_up(pieces: pa.Table, counts: pa.Table) -> pa.Table:
    """(lang, piece, f) by composing the pieces' automaton with the counts."""
    words = [tuple(p.encode().split(b" ")) for p in pieces.column("piece").to_pylist()]
    known = sorted({w for p in words for w in p})
    number = {w: i + 1 for i, w in enumerate(known)}
    places = np.array([[number[p[k]] if k < len(p) else 0 for p in words] for k in range(3)], np.int64).reshape(3, -1)
    asked = Automaton.of(_summed(known, places, np.ones(len(words), np.int64))).ngrams()
    data = counts.column("automaton").to_pylist()
    found = Automaton.from_bytes(data[0]).compose(asked) if data else np.zeros(len(asked), np.int64)
    names = [b" ".join(p).decode() for p in asked.phrases()]
    lang = pieces.column("lang")[0].as_py() if len(words) else None
    return pa.table({"lang": pa.array([lang] * len(names), pa.string()), "piece": pa.array(names, pa.string()), "f": pa.array(found, pa.int64())})


def _ranges(rows: DataFrame) -> dict[str, Ranges]:
    """For each language with more than one range. A row a language, and a bounded sample, come to the driver."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    small = size <= SAMPLE_BYTES
    sizes = rows.groupBy("lang").agg(F.sum(size).alias("bytes"), F.count_if(small).alias("small")).filter(F.col("bytes") > RANGE_BYTES)
    sizes = {r["lang"]: (r["bytes"], r["small"]) for r in sizes.collect()}
    out = {}
    for lang, (total, known) in sizes.items():
        own = rows.filter((F.col("lang") == lang) & small & (F.pmod(F.xxhash64("text"), F.lit(known)) < SAMPLE))
        sample = [(r["text"] or "").encode() for r in own.select("text").limit(2 * SAMPLE).collect()] if known else []
        out[lang] = Ranges.over(sample, -(-total // RANGE_BYTES))
    return out


def _pieces_of(cuts: DataFrame, united_: DataFrame) -> DataFrame:
    """(lang, piece, f, n): what the pieces count, and in how many cuts each occurs."""
    pieces = cuts.groupBy("lang", "part", "piece").agg(F.count(F.lit(1)).alias("n"))
    pieces = materialize(pieces, "pieces")
    keys = "lang", "part"
    found = pieces.groupBy(*keys).cogroup(united_.groupBy(*keys)).applyInArrow(_look_up, "lang string, piece string, f long")
    return materialize(found.join(pieces.drop("part"), ["lang", "piece"]), "piece-counts")


def _floored(a: Column, l: Column, r: Column) -> Column:
    a, l, r = (x.cast("decimal(15,0)") for x in (a, l, r))
    top = (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, l * r)


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    min_count: int = MIN_COUNT,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(_ranges(rows))
    shards = rows.mapInArrow(_build(sent), "lang string, part long, automaton binary")
    counts = shards.groupBy("lang", "part").applyInArrow(_unite(min_count), "lang string, part long, automaton binary, n long")
    counts = materialize(counts, "automata")
    schema = "lang string, phrase string, words int, a long, cut int, is_left boolean, part long, piece string"
    cuts = materialize(counts.select("lang", "automaton").mapInArrow(_cut(sent), schema), "cuts")
    weighed = join_facts(cuts, _pieces_of(cuts, counts), ["lang", "piece"], cuts.count())
    per_cut = weighed.groupBy("lang", "phrase", "words", "a", "cut").agg(
        F.max(F.when(F.col("is_left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_left"), F.col("f"))).alias("r")
    )
    worst = F.min(F.struct(_floored(F.col("a"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r")).alias("worst")
    scored = per_cut.groupBy("lang", "phrase", "words", "a").agg(worst).select("lang", "phrase", "words", "a", "worst.l", "worst.r", "worst.score")
    # A piece of two words of a phrase of three is a candidate inside it.
    longer = cuts.filter("words = 3 AND is_left = (cut = 2)").groupBy("lang", F.col("piece").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        (F.col("words") == 3) | F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))
    )
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    # Ranked in parts first, so that a language sends a bounded number of rows to its last task.
    part = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = part.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )


def oracle_sql() -> str:
    return rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i
  FROM (SELECT lang, row_number() OVER () AS r, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p)
), t AS (
  SELECT lang, w AS x, lead(w, 1) OVER q AS y, lead(w, 2) OVER q AS z FROM w WINDOW q AS (PARTITION BY r ORDER BY i)
), f AS (
  SELECT lang, 1 AS k, x AS phrase, x, NULL AS y, NULL AS z, count(*)::HUGEINT AS f FROM t GROUP BY ALL
  UNION ALL SELECT lang, 2, x || ' ' || y, x, y, NULL, count(*) FROM t WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z, x, y, z, count(*) FROM t WHERE z IS NOT NULL GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), g AS (
  SELECT * FROM f WHERE f >= {MIN_COUNT}
), c AS (
  SELECT lang, phrase, k, f AS a, 1 AS cut, x AS u, concat_ws(' ', y, z) AS v FROM g WHERE k > 1
  UNION ALL SELECT lang, phrase, k, f, 2, x || ' ' || y, z FROM g WHERE k = 3
), s AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, o.f AS l, e.f AS r, 1000000 * c.a * c.a // (o.f * e.f) AS score
  FROM c JOIN g o ON o.lang = c.lang AND o.phrase = c.u JOIN g e ON e.lang = c.lang AND e.phrase = c.v
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, f AS a, unnest([x || ' ' || y, y || ' ' || z]) AS phrase FROM g WHERE k = 3) GROUP BY ALL
), d AS (
  SELECT b.* EXCLUDE (k, cut) FROM b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase AND b.k = 2
  WHERE i.longer IS NULL OR 100 * i.longer < {SHARE} * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM d JOIN n USING (lang) QUALIFY rank <= {TOP}"""
