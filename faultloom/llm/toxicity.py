"""Toxicity by a convolutional text classifier, trained and run in numpy.

A word is a row of a hashed embedding table. Filters of several widths slide over
all words of a text, each keeps its largest answer, and a logistic layer weighs
the answers. Thresholds are calibrated for each language, which is guessed from
the function words of the text itself; scores are shifted by the logit of the
threshold, so 0.5 decides in every language.

Learning takes every labelled row that has a text, whatever its length. The rows
are dealt by a hash of the id to shards of about ``SHARD_ROWS``, which are encoded
once and written. In each epoch every shard takes the common model one lap further
in a task of its own, and Spark averages the models: a word's row over the shards
that moved it. The words' leanings before that, and the thresholds after it, are
counted by Spark over all shards. The driver sees a model, whose size is fixed, and
counts per bucket of words or of logits. Scoring reads whole texts, each document in
its own task's scan, without a shuffle.

A null text counts as empty; an empty text has the score that no word gives.
Null ids are held out (they are never joined to labels). Repeated ids are scored
row by row. Without labels of both classes all scores are 0.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import batch, forget, free_name, give_back, kept, sliced, small_batches, texts_as_bytes
from faultloom.session import materialize

#: What a shard holds about: so many rows, and no more than so many bytes of text.
SHARD_ROWS, SHARD_BYTES = 8_000, 32 << 20
FOLDS = 5

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 8
EPOCHS, BATCH, RATE = 6, 64, 0.01
#: Words of one numpy step, texts of one, words remembered with their codes, rows a language needs for its own threshold.
CHUNK, SLICE, WORDS, OWN_ROWS = 200_000, 500, 100_000, 60

# Function words by which a text's language is guessed.
LANGUAGES = {
    "en": "the of and to in that is for it was with be by are this from",
    "de": "der die und den von zu das mit sich auf für ist dem nicht ein",
    "fr": "le et les des du une que pour dans par sur est avec au pas",
    "es": "el los las y del con no por su para al lo como se un",
}
_EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_/\\"


class Codes(dict):
    """Word to a four-byte code: its bucket and, from bit 20 on, the language it speaks for."""

    def __init__(self):
        super().__init__()
        spoken = [w for ws in LANGUAGES.values() for w in ws.split()]
        self.languages = {
            w.encode(): i + 1
            for i, ws in enumerate(LANGUAGES.values())
            for w in ws.split()
            if spoken.count(w) == 1
        }

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= WORDS:
            self.clear()
        bare = word.strip(_EDGES) or word
        # Bucket 0 is padding.
        bucket = 1 + xxhash.xxh32_intdigest(bare) % (BUCKETS - 1)
        code = bucket | self.languages.get(bare, 0) << 20
        value = self[word] = code.to_bytes(4, "little")
        return value


def encode(texts: list[bytes]) -> list[np.ndarray]:
    """Codes of the words of each text; an empty text is one padding word."""
    codes, pad = kept("toxicity", Codes), bytes(4)
    return [
        np.frombuffer(b"".join(map(codes.__getitem__, t.lower().split())) or pad, dtype=np.int32)
        for t in texts
    ]


class Model(NamedTuple):
    table: np.ndarray
    filters: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    bias: float
    shifts: np.ndarray  # logits of the thresholds: no language, then each of LANGUAGES


def _laid_out(coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of texts in a row with padding between them; where each text starts and ends."""
    gap = np.zeros(max(WIDTHS) - 1, np.int32)
    row = np.concatenate([x for c in coded for x in (c, gap)])
    sizes = np.array([len(c) for c in coded])
    starts = np.concatenate([[0], np.cumsum(sizes + len(gap))[:-1]])
    return row & (BUCKETS - 1), starts, starts + sizes


def _answers(model: Model, row: np.ndarray) -> np.ndarray:
    """Every filter at every word, one row per word."""
    embedded = model.table[row]
    out = np.empty((len(row), len(WIDTHS) * FILTERS), np.float32)
    for k, w in enumerate(WIDTHS):
        a = embedded @ model.filters[k][0]
        for j in range(1, w):
            a[:-j] += embedded[j:] @ model.filters[k][j]
        out[:, k * FILTERS : (k + 1) * FILTERS] = a
    return out


def _pooled(answers: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    cuts = np.ravel(np.column_stack([starts, ends]))
    return np.maximum.reduceat(answers, cuts, axis=0)[::2]


def _features(model: Model, coded: list[np.ndarray]) -> np.ndarray:
    """Pooled answers of each text, in steps of a bounded number of words; long texts take several."""
    found = np.full((len(coded), len(WIDTHS) * FILTERS), -np.inf, np.float32)
    part, owners, size = [], [], 0

    def step() -> None:
        row, starts, ends = _laid_out(part)
        np.maximum.at(found, owners, _pooled(_answers(model, row), starts, ends))
        part.clear(), owners.clear()

    overlap = max(WIDTHS) - 1
    for i, codes in enumerate(coded):
        for a in range(0, len(codes), CHUNK):
            part.append(codes[a : a + CHUNK + overlap])
            owners.append(i)
            size += len(part[-1])
            if size >= CHUNK:
                step()
                size = 0
    if part:
        step()
    return np.maximum(found + model.biases, 0)


def _languages(coded: list[np.ndarray]) -> np.ndarray:
    counts = np.array([np.bincount(c >> 20, minlength=len(LANGUAGES) + 1) for c in coded])
    counts[:, 0] = 0
    return np.where(counts.any(axis=1), counts.argmax(axis=1), 0)


def logits(model: Model, coded: list[np.ndarray]) -> np.ndarray:
    return _features(model, coded) @ model.weights + model.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.empty(0)
    coded = encode(texts)
    return _sigmoid(logits(model, coded).astype(np.float64) - model.shifts[_languages(coded)])


def _noise(rng: np.random.Generator) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Small random numbers: a table, filters, weights."""
    table = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    return table, filters, rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)


def _seen(coded: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """In how many texts of each class a bucket occurs."""
    seen = np.zeros((2, BUCKETS))
    for c, y in zip(coded, toxic, strict=True):
        seen[y, np.unique(c & (BUCKETS - 1))] += 1
    return seen


class _State:
    """A model on its way: the table, all that is not the table, and how the steps of that have gone."""

    def __init__(self, seen: np.ndarray, sizes: np.ndarray, rng: np.random.Generator):
        """Small random numbers, but the first coordinate of a word tells how far it leans to a class."""
        n = np.maximum(1, sizes)
        share = seen.sum(axis=0) / n.sum()
        spread = np.sqrt(share * (1 - share) * (1 / n).sum()) + 1e-3
        lean = (seen[1] / n[1] - seen[0] / n[0]) / spread
        self.table, filters, weights = _noise(rng)
        self.table[:, 0] = np.clip(np.sign(lean) * np.maximum(np.abs(lean) - 3.5, 0) / 4, -2, 2)
        self.table[0] = 0
        for f in filters:
            f[:, 0, : FILTERS // 2] += 1 / len(f)
        self.dense = [*filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), weights, np.zeros(1, np.float32)]
        self.m, self.v = ([np.zeros_like(x) for x in self.dense] for _ in range(2))
        self.t = 0.0

    def model(self) -> Model:
        *filters, biases, weights, bias = self.dense
        return Model(self.table, filters, biases, weights, float(bias[0]), np.zeros(len(LANGUAGES) + 1))

    def step(self, coded: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray) -> None:
        """One step of Adam; the table's is plain."""
        grads = _gradients(self.model(), self.dense[-1][0], coded, toxic, weight)
        rows, row_grads = grads.pop()
        self.t += 1
        for value, m, v, grad in zip(self.dense, self.m, self.v, grads, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= RATE * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.99**self.t)) + 1e-6)
        np.add.at(self.table, rows, -RATE * 5 * row_grads)
        self.table[0] = 0

    def flat(self) -> np.ndarray:
        """All but the table as rows of DIM numbers."""
        row = np.concatenate([x.ravel() for x in (*self.dense, *self.m, *self.v)] + [np.array([self.t], np.float32)])
        return np.pad(row, (0, -len(row) % DIM)).reshape(-1, DIM)

    def set_flat(self, rows: np.ndarray) -> None:
        row, at = rows.ravel(), 0
        for group in (self.dense, self.m, self.v):
            for i, x in enumerate(group):
                group[i] = row[at : at + x.size].reshape(x.shape).astype(np.float32)
                at += x.size
        self.t = float(row[at])


def _split(n: int, seed: int, everything: bool) -> tuple[np.random.Generator, np.ndarray, np.ndarray]:
    """One row in five, kept to calibrate the thresholds, and those to learn from: the rest, or everything."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    return rng, order[: n // 5], order if everything else order[n // 5 :]


def _laps(state: _State, coded: list, toxic: np.ndarray, sizes: np.ndarray, laps: range, seed: int, everything: bool) -> None:
    """Take a model these laps further over a shard. ``sizes``: rows of each class, of all shards."""
    rng, _, kept = _split(len(coded), seed, everything)
    _noise(rng)
    weight = np.where(toxic == 1, 0.5 / max(1, sizes[1]), 0.5 / max(1, sizes[0])) * sizes.sum()
    for lap in range(laps.stop):
        order = rng.permutation(kept)
        for a in range(0, len(order) if lap in laps else 0, BATCH):
            part = order[a : a + BATCH]
            state.step([coded[i] for i in part], toxic[part], weight[part])


def train(texts: list[bytes], toxic: np.ndarray, seed: int = 7) -> Model | None:
    return fit(encode(texts), toxic, seed)


def fit(coded: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> Model | None:
    """A model of the rows as one shard, or None if a class is missing."""
    toxic = np.asarray(toxic, dtype=np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    _, held, some = _split(len(coded), seed, False)
    everything = toxic[some].min() == toxic[some].max()
    rng, held, some = _split(len(coded), seed, everything)
    sizes = np.bincount(toxic[some], minlength=2)
    state = _State(_seen([coded[i] for i in some], toxic[some]), sizes, rng)
    _laps(state, coded, toxic, sizes, range(EPOCHS), seed, everything)
    z, language = _judged(state.model(), [coded[i] for i in held])
    return state.model()._replace(shifts=_shifts(language, z, z, np.ones(len(z), np.int64), toxic[held]))


def _gradients(model: Model, bias: float, coded: list, y: np.ndarray, weight: np.ndarray) -> list:
    """Of the filters, their biases, the weights, the bias, and (rows, gradients) of the table."""
    row, starts, ends = _laid_out(coded)
    answers = _answers(model, row)
    best = np.stack([s + answers[s:e].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
    top = np.take_along_axis(answers, best, axis=0) + model.biases
    pooled = np.maximum(top, 0)
    slope = (_sigmoid(pooled @ model.weights + bias) - y) * weight / len(y)
    back = slope[:, None] * model.weights * (top > 0)
    grads, rows, row_grads = [], [], []
    for k, w in enumerate(WIDTHS):
        at, g = best[:, k * FILTERS : (k + 1) * FILTERS], back[:, k * FILTERS : (k + 1) * FILTERS]
        words = np.minimum(at[None] + np.arange(w)[:, None, None], len(row) - 1)  # width, text, filter
        embedded = model.table[row[words]]
        grads.append(np.einsum("tf,wtfd->wdf", g, embedded).astype(np.float32))
        rows.append(row[words].ravel())
        row_grads.append(np.einsum("tf,wdf->wtfd", g, model.filters[k]).reshape(-1, DIM))
    grads += [back.sum(axis=0), (slope @ pooled).astype(np.float32) + 1e-4 * model.weights, np.array([slope.sum()], np.float32)]
    return [*grads, (np.concatenate(rows), np.concatenate(row_grads).astype(np.float32))]


def _judged(model: Model, coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits and languages."""
    if not coded:
        return np.empty(0, np.float32), np.empty(0, np.int64)
    return logits(model, coded), _languages(coded)


def _threshold(low: np.ndarray, high: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> float:
    """The logit that parts the classes with the best F1, in the middle of its gap. Of bins: ends, rows, toxic ones."""
    order = np.argsort(-high, kind="stable")
    low, high, n, toxic = low[order], high[order], n[order], toxic[order]
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(n) + toxic.sum())
    k = int(f1.argmax())
    return float((low[k] + (high[k + 1] if k + 1 < len(low) else low[k] - 1)) / 2)


def _shifts(language: np.ndarray, *bins: np.ndarray) -> np.ndarray:
    """The thresholds of the languages; those with few rows have that of all."""
    n, toxic = bins[2:]
    if not toxic.any():
        return np.zeros(len(LANGUAGES) + 1)
    out = np.full(len(LANGUAGES) + 1, _threshold(*bins))
    for k in range(len(out)):
        own = language == k
        if n[own].sum() >= OWN_ROWS and toxic[own].sum() >= OWN_ROWS // 6:
            out[k] = _threshold(*[b[own] for b in bins])
    return out


def fold(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(FOLDS))


def training(docs: DataFrame, labels: DataFrame, id: str, text: str, of: Callable[[Column], Column] = F.col) -> DataFrame:
    """(order, text, toxic) of every row to learn from, with something made of the text before it is shuffled in its place."""
    known = labels.filter(F.col(id).isNotNull() & F.col("toxic").isNotNull() & (fold(F.col(id)) != 0))
    known = known.select(F.col(id).alias("id"), "toxic").groupBy("id").agg(F.max("toxic").alias("toxic"))
    some = docs.filter(F.col(text).isNotNull() & (fold(F.col(id)) != 0))
    # Labels grow with the documents; never broadcast them.
    known = known.filter("toxic IN (0, 1)").hint("merge")
    found = some.select(F.col(id).alias("id"), of(text).alias("text")).join(known, "id")
    return found.select(F.xxhash64("id").alias("order"), "text", "toxic")


def _encoded(text: str) -> Column:
    """The codes of a text's words."""

    @F.arrow_udf("binary")
    def codes(texts: pa.Array) -> pa.Array:
        parts = [texts.slice(lo, SLICE) for lo in range(0, len(texts), SLICE)]
        return pa.array([c.tobytes() for part in parts for c in encode(texts_as_bytes(part))], pa.binary())

    return codes(F.col(text))


_SHARD = pa.schema([("shard", pa.int32()), ("codes", pa.binary()), ("lengths", pa.binary()), ("toxic", pa.binary())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per shard with the codes of its texts one after the other. Rows come sorted by shard."""
    shard, coded, toxic = None, [], []

    def row() -> pa.RecordBatch:
        lengths = np.array([len(c) for c in coded], np.int64)
        parts = (np.concatenate(coded).astype(np.int32), lengths, np.array(toxic, np.int8))
        return batch(_SHARD, {"shard": [shard], **{f.name: [x.tobytes()] for f, x in zip(list(_SHARD)[1:], parts, strict=True)}})

    for part in sliced(batches):
        shards = part.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if coded and shards[lo] != shard:
                yield row()
                coded, toxic = [], []
            own = part.slice(lo, hi - lo)
            shard = int(shards[lo])
            coded += [np.frombuffer(c.as_buffer(), np.int32) for c in own.column("text")]
            toxic += own.column("toxic").to_pylist()
    if coded:
        yield row()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    for b in batches:
        for shard, codes, lengths, toxic in zip(*[b.column(f.name) for f in _SHARD], strict=True):
            ends = np.cumsum(np.frombuffer(lengths.as_buffer(), np.int64))
            coded = np.split(np.frombuffer(codes.as_buffer(), np.int32), ends[:-1])
            yield shard.as_py(), coded, np.frombuffer(toxic.as_buffer(), np.int8).astype(np.int64)


_COUNTS = pa.schema([("bucket", pa.int32()), ("clean", pa.int64()), ("toxic", pa.int64())])
_VALUES = pa.schema([("bucket", pa.int32()), *[(f"v{d}", pa.float32()) for d in range(DIM)]])
_JUDGED = pa.schema([("language", pa.int32()), ("z", pa.float32()), ("toxic", pa.int64())])


def _spark(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.float32(): "float", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _counted(shards: DataFrame, seed: int, everything: bool) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class by bucket, and in all. A row per bucket comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, coded, toxic in _unpacked(batches):
            _, _, some = _split(len(coded), seed + shard, everything)
            seen = _seen([coded[i] for i in some], toxic[some])
            met = np.flatnonzero(seen.any(axis=0))
            rows = np.append(seen[:, met], np.bincount(toxic[some], minlength=2)[:, None], axis=1).astype(np.int64)
            yield batch(_COUNTS, {"bucket": np.append(met, -1).astype(np.int32), "clean": rows[0], "toxic": rows[1]})

    counts = shards.mapInArrow(count, _spark(_COUNTS)).groupBy("bucket")
    found = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    bucket = found["bucket"].to_numpy()
    both = np.zeros((2, BUCKETS + 1), np.int64)
    # The last place, -1, has the rows.
    both[:, bucket] = [found["clean"].to_numpy(), found["toxic"].to_numpy()]
    return both[:, :-1].astype(float), both[:, -1]


def _averaged(shards: DataFrame, state: _State, sizes: np.ndarray, laps: range, seed: int, everything: bool) -> None:
    """Every shard takes the model these laps further; then it is the average of theirs."""
    sent = shards.sparkSession.sparkContext.broadcast(state)

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, coded, toxic in _unpacked(batches):
            own = copy.deepcopy(sent.value)
            _laps(own, coded, toxic, sizes, laps, seed + shard, everything)
            moved = np.flatnonzero((own.table != sent.value.table).any(axis=1))
            flat = own.flat()
            rows = np.concatenate([own.table[moved], flat])
            bucket = np.concatenate([moved, -1 - np.arange(len(flat))]).astype(np.int32)
            yield batch(_VALUES, {"bucket": bucket, **{f"v{d}": np.ascontiguousarray(rows[:, d]) for d in range(DIM)}})
        # What learning took would else stay with the worker.
        forget()
        give_back()

    values = shards.mapInArrow(move, _spark(_VALUES)).groupBy("bucket")
    found = values.agg(*[F.avg(f"v{d}").cast("float").alias(f"v{d}") for d in range(DIM)]).toArrow()
    sent.destroy()
    bucket = found["bucket"].to_numpy()
    rows = np.column_stack([found[f"v{d}"].to_numpy() for d in range(DIM)])
    state.table[bucket[bucket >= 0]] = rows[bucket >= 0]
    state.set_flat(rows[bucket < 0][np.argsort(-bucket[bucket < 0])])


def _calibrated(shards: DataFrame, model: Model, seed: int) -> np.ndarray:
    """The thresholds by all rows kept for them, in bins of a thousandth of a logit, which come to the driver."""
    sent = shards.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, coded, toxic in _unpacked(batches):
            _, held, _ = _split(len(coded), seed + shard, False)
            z, language = _judged(sent.value, [coded[i] for i in held])
            yield batch(_JUDGED, {"language": language.astype(np.int32), "z": z.astype(np.float32), "toxic": toxic[held]})

    judged = shards.mapInArrow(judge, _spark(_JUDGED))
    # Logits beyond a hundred share the outer bins.
    bins = judged.groupBy("language", F.floor(F.least(F.greatest(F.col("z"), F.lit(-100.0)), F.lit(100.0)) * 1000).alias("bin"))
    found = bins.agg(F.min("z").alias("low"), F.max("z").alias("high"), F.count("*").alias("n"), F.sum("toxic").alias("toxic")).toArrow()
    sent.destroy()
    return _shifts(*[found[name].to_numpy() for name in ("language", "low", "high", "n", "toxic")])


def learnt(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 7) -> Model | None:
    """The model of all labelled rows, or None if a class is missing."""
    lengths = training(docs, labels, id, text, F.octet_length)
    n, size, toxic = lengths.agg(F.count("*"), F.sum("text"), F.sum("toxic")).first()
    if not n or toxic in (0, n):
        return None
    parts = max(-(-n // SHARD_ROWS), -(-size // SHARD_BYTES))
    rows = training(docs, labels, id, text, _encoded)
    dealt = rows.withColumn("shard", F.pmod("order", F.lit(parts)).cast("int")).repartitionById(parts, "shard")
    # Sorted, so that a model can be made again.
    packed = dealt.sortWithinPartitions("shard", "order", "text").mapInArrow(_packed, _spark(_SHARD))
    shards = materialize(packed, "toxicity-shards")
    everything = False
    seen, sizes = _counted(shards, seed, everything)
    if not sizes.all():
        everything = True
        seen, sizes = _counted(shards, seed, everything)
    rng, _, _ = _split(n, seed, everything)
    state = _State(seen, sizes, rng)
    # One shard has nothing to average between its laps.
    for laps in [range(EPOCHS)] if parts == 1 else [range(e, e + 1) for e in range(EPOCHS)]:
        _averaged(shards, state, sizes, laps, seed, everything)
    return state.model()._replace(shifts=_calibrated(shards, state.model(), seed))


def with_score(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    into: str = "score",
) -> DataFrame:
    """The rows with a score from 0 to 1; 0.5 and more is toxic."""
    small_batches(docs.sparkSession)
    model = learnt(docs, labels, id, text)
    if model is None:
        return docs.withColumn(into, F.lit(0.0))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    del model

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        # In slices, so that little of a batch is Python objects at a time.
        parts = [texts.slice(lo, SLICE) for lo in range(0, len(texts), SLICE)]
        found = [scores(sent.value, texts_as_bytes(part)) for part in parts]
        return pa.array(np.concatenate([np.empty(0), *found]))

    # Not deterministic, for Spark: else a filter on the score would have it made twice.
    return docs.withColumn(into, score.asNondeterministic()(F.col(text)))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    scored = with_score(docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def filtered(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not toxic, with their columns."""
    score = free_name(docs, "toxicity")
    return with_score(docs, labels, into=score).filter(F.col(score) < 0.5).drop(score)
