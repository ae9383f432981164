import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from faultloom.llm import ngrams as g


def split(text):
    low = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + ["\n"]


def brute(docs, quantised):
    out = []
    train = [d for d in docs if zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 5 != 1]
    one, two = Counter(), Counter()
    for _, text in train:
        ts = split(text)
        one.update(ts)
        two.update(zip(["\n", *ts[:-1]], ts, strict=True))
    n, v = sum(one.values()), len(one)
    for doc_id, text in docs:
        ts = split(text)
        base = sum(math.log10((one[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        score = 0.0
        for a, b in zip(["\n", *ts[:-1]], ts, strict=True):
            ca, cb, cab = quantised(one[a]), quantised(one[b]), quantised(two[a, b])
            p = (cb + 0.5) / (n + 0.5 * (v + 1))
            score += math.log10((min(ca, cb, cab) + g.PRIOR * p) / (ca + g.PRIOR))
        out.append((doc_id, len(ts), sum(one[t] > 0 for t in ts), n, base, score))
    return out


def same(rows, docs):
    quantised = lambda c: float(g.count_of(g.level(np.array([c])))[0]) if c else 0.0
    want = sorted(brute(docs, quantised), key=lambda x: (x[0] is not None, x[0] or 0, x[4]))
    got = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.base_score))
    assert len(got) == len(want)
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], abs=1e-6)
        # False hits of the filter can only raise a few tokens.
        assert r.score == pytest.approx(w[5], rel=0.02, abs=1.0)


@pytest.mark.parametrize("hot", [0, 50, 200_000])
def test_table(spark, sf_dir, monkeypatch, hot):
    monkeypatch.setattr(g, "HOT_WORDS", hot)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = g.score(docs).collect()
    same(rows, [(r.doc_id, r.text) for r in docs.collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark):
    docs = [(1, "a B a"), (2, None), (3, ""), (4, "a b c É"), (5, "x " * 20_000), (None, "a b"), (4, "a b c É"), (8, "never seen")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    same(g.score(df).collect(), docs)
    assert g.score(df.limit(0)).count() == 0
    same(g.score(df.filter("doc_id = 1")).collect(), [docs[0]])


def test_levels_tell_the_count():
    counts = np.arange(1, 3000)
    back = g.count_of(g.level(counts))
    assert (np.abs(back / counts - 1) < g.BASE - 1).all() and back[0] == 1


def test_filter(spark):
    texts = [" ".join(f"w{i % 97}" for i in range(k, k + 200)) for k in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = g.build_filter(df, 60_300)
    known = g.WordHashes()
    assert model.counts(known.of([b"w5"]))[0] == g.count_of(g.level(np.array([sum(t.split().count("w5") for t in texts)])))[0]
    strange = g.mixed(np.arange(100_000, dtype=np.uint64))
    assert (model.levels(strange) > 0).mean() <= max(0.002, 3 * model.error_rate())


def test_filter_grows_with_its_entries(spark):
    """Words that occur once make two entries a token."""
    texts = [" ".join(f"w{k}x{i}" for i in range(1000)) for k in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert g.build_filter(df, 300_300).error_rate() < 0.03
    assert g.segments_for(6_000_000_000) * g.SEGMENT_TOKENS >= 6_000_000_000


def test_levels_end_in_a_full_filter():
    full = g.Filter(np.array([64, 64]), np.full(128, np.iinfo(np.uint64).max, np.uint64), 7)
    assert (full.levels(g.mixed(np.arange(1000, dtype=np.uint64))) == 7).all()


@pytest.mark.parametrize("tokens", [500, 1 << 20])
def test_filter_that_is_not_broadcast(spark, sf_dir, monkeypatch, tokens):
    monkeypatch.setattr(g, "SEGMENT_TOKENS", tokens)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(None, None), (4, "a b c É"), (4, "a b c É")], docs.schema))
    want = sorted(map(tuple, g.score(docs).collect()), key=repr)
    monkeypatch.setattr(g, "BROADCAST_BYTES", -1)
    got = sorted(map(tuple, g.score(docs).collect()), key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=0, atol=1e-9)
    assert g.score(docs.limit(0)).count() == 0


def test_probes_of_a_filter_that_is_not_broadcast_are_small(spark, monkeypatch):
    """A row for each chunk and segment, and a byte for each level; also where a chunk is read in pieces."""
    texts = [" ".join(f"w{k}x{i % (k + 7)}" for i in range(60)) for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(g, "SEGMENT_TOKENS", 5_000)
    want = sorted(map(tuple, g.score(docs).collect()))
    written, kept = {}, g.materialize

    def seen(df, tag):
        written[tag] = out = kept(df, tag)
        return out

    monkeypatch.setattr(g, "materialize", seen)
    monkeypatch.setattr(g, "BROADCAST_BYTES", -1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "90")
    try:
        got = sorted(map(tuple, g.score(docs).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r[:5] for r in got] == [r[:5] for r in want] and np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=0, atol=1e-9)
    levels = written["levels"]
    assert "probes" not in written and levels.count() < 40 * g.segments_for(24_400)
    grams = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64))
    assert (g._unpacked(g._packed(grams)) == grams).all() and len(g._packed(grams)) == 40_000
