import re
from collections import Counter

import numpy as np
import oracle
import pytest

from faultloom.llm import collocations as c


def ngrams_of(text):
    text = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    for piece in re.split("[.,;:!?\n-\r]", text):
        ws = [w for w in re.split("[ \t]+", piece) if w]
        for k in (1, 2, 3):
            yield from (tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))


def brute(docs, top=2000):
    f = {}
    for lang, text in docs:
        f.setdefault("und" if lang is None else lang, Counter()).update(ngrams_of(text))
    out = []
    for lang, counts in f.items():
        n = sum(k for p, k in counts.items() if len(p) == 1)
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= 10}
        rows = []
        for p, a in frequent.items():
            inside = [x for q, x in frequent.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * x >= 50 * a for x in inside):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def rows(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_table_and_sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r.lang, r.text) for r in docs.collect()])
    assert len(want) > 50
    assert rows(c.collocations(docs)) == want
    con = oracle.connect(sf_dir)
    cursor = con.execute(c.oracle_sql())
    at = [[d[0] for d in cursor.description].index(k) for k in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")]
    assert sorted(tuple(r[i] for i in at) for r in cursor.fetchall()) == want


def some_docs(seed=1):
    rng = np.random.default_rng(seed)
    words = ["a", "B", "cé", "x-y", "中", "of", "the", "zz\x01", "(q)"]
    marks = [" ", " ", " ", " ", "\t", ". ", ",", "\n", "  "]
    out = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(int(rng.integers(0, 60))))
        text += " new york city" * int(rng.integers(0, 3))
        out.append((["en", "fr", None, "und"][i % 4] if i % 3 else "en", text))
    return out + [("en", None), ("en", ""), ("de", " .. "), (None, "\x0b\x0c"), ("it", "uno due " * 10), ("it", "uno due " * 10)]


@pytest.mark.parametrize(
    "shard, slice_, ranges, cuts, run",
    [(8 << 20, 2_000_000, 8 << 20, 4096, 1 << 18), (300, 50, 200, 4096, 5), (500, 7, 100, 3, 1), (10**6, 1, 10**6, 2, 2)],
)
def test_edges_at_any_size_of_shard_and_range(spark, monkeypatch, shard, slice_, ranges, cuts, run):
    for name, value in (("SHARD_BYTES", shard), ("SLICE", slice_), ("RANGE_BYTES", ranges), ("CUTS", cuts), ("RUN", run)):
        monkeypatch.setattr(c, name, value)
    docs = some_docs()
    df = spark.createDataFrame([(*d, 1, "n") for d in docs], "lang string, text string, a int, part string")
    want = brute(docs)
    assert {r[0] for r in want} == {"en", "fr", "und", "it"}
    assert rows(c.collocations(df)) == want
    assert c.collocations(df.limit(0)).count() == 0


def test_top_keeps_ties_in_order(spark):
    docs = [("en", f"p{i} q{i}. " * 10) for i in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows(c.collocations(df, top=7)) == brute(docs, 7)


def random_ngrams(rng, n, words=30):
    found = {}
    for _ in range(n):
        k = int(rng.integers(1, 4))
        p = tuple(f"w{int(x)}".encode() for x in np.minimum(rng.geometric(0.2, k), words))
        found[p] = found.get(p, 0) + int(rng.integers(1, 4))
    return found


def ordered(found):
    words = sorted({w for p in found for w in p})
    number = {w: i + 1 for i, w in enumerate(words)}
    some = sorted(found)
    places = np.array([[number[p[k]] if k < len(p) else 0 for p in some] for k in range(3)], np.int64).reshape(3, -1)
    return c.Ngrams(words, places, np.array([found[p] for p in some], np.int64))


def back(ngrams):
    return dict(zip(ngrams.phrases(), ngrams.weights.tolist(), strict=True))


@pytest.mark.parametrize("low", [c._LOW, np.uint64(3)])
def test_automata(monkeypatch, low):
    """Bytes and back, union of shards, composition, and shared nodes."""
    monkeypatch.setattr(c, "_LOW", low)
    rng = np.random.default_rng(4)
    for run in (1, 3, 1 << 18):
        monkeypatch.setattr(c, "RUN", run)
        shards = [random_ngrams(rng, int(n)) for n in rng.integers(0, 400, 6)]
        automata = [c.Automaton.from_bytes(c.Automaton.of(ordered(s)).to_bytes()) for s in shards]
        assert [back(a.ngrams()) for a in automata] == shards
        total = sum((Counter(s) for s in shards), Counter())
        union = c.united(automata)
        assert union.phrases() == sorted(total) and back(union) == dict(total)
        asked = ordered({**random_ngrams(rng, 200, 60), (b"none",): 1, (b"w1", b"none"): 1, (b"w1", b"w1", b"none"): 1})
        assert c.Automaton.of(union).compose(asked).tolist() == [total[p] for p in asked.phrases()]
    # The last words of these two are one node.
    same = c.Automaton.of(ordered({(b"a", b"b", b"x"): 2, (b"a", b"b", b"y"): 1, (b"c", b"d", b"x"): 2, (b"c", b"d", b"y"): 1}))
    assert same.node.tolist() == [1, 1] and len(same.arc) == 2


def test_ranges_put_each_ngram_in_one_place():
    rng = np.random.default_rng(6)
    ngrams = ordered(random_ngrams(rng, 900))
    some = ngrams.phrases()
    for cuts, tasks in (([], 1), (some[::40], 1), (some[1::90], 3), ([(b"w1", b"v"), (b"w1", b"w1", b"zz"), (b"zz",)], 2)):
        ranges = c.Ranges(cuts, tasks)
        found = {p: k for k, own in ranges.split(ngrams) for p in own.phrases()}
        assert found == {p: ranges.of(p) for p in some}


def test_hot_pair_is_spread():
    """A pair that begins a third of all n-grams is cut into several ranges."""
    text = b" ".join(b"hot pair w%d" % (i * 7919 % 100_003) for i in range(3000))
    ranges = c.Ranges.over([text], 30)
    sizes = [len(own) for n in c.counted(c.words_and_marks([text])) for _, own in ranges.split(n)]
    assert len(sizes) == 30 and max(sizes) < 2 * sum(sizes) / 30
