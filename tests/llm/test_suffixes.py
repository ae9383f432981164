import hashlib
from collections import defaultdict

import numpy as np
import pytest

from faultloom.llm import suffixes as s

N = s.LENGTH


def brute(texts):
    """Per text (bytes): n_bytes, n_removed, n_spans, sha256 of what stays."""
    places = defaultdict(list)
    for k, t in enumerate(texts):
        for i in range(len(t) - N + 1):
            places[t[i : i + N]].append((k, i))
    gone = [np.zeros(len(t) + 1, np.int8) for t in texts]
    for at in places.values():
        if len(at) > 1:
            for k, i in at:
                gone[k][i : i + N] = 1
    out = []
    for t, g in zip(texts, gone, strict=True):
        kept = bytes(b for b, x in zip(t, g[:-1], strict=True) if not x)
        out.append((len(t), int(g.sum()), int((np.diff(np.concatenate([[0], g])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def same(spark, docs):
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, spans string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in s.remove_repeats(df).collect())
    want = [(d, *w) for (d, _), w in zip(docs, brute([(t or "").encode() for _, t in docs]), strict=True)]
    assert got == sorted(want)
    return want


def test_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = same(spark, docs)
    assert sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("small", [False, True])
def test_planted_and_edges(spark, monkeypatch, small):
    if small:  # several shards, anchors over several shards, long texts in parts
        for name, value in (("SHARD_BYTES", 3000), ("SNIPPETS", 3), ("MERGED", 300), ("LONG_TEXT", 700), ("TEXT_BYTES", 500), ("REMEMBERED", 2)):
            monkeypatch.setattr(s, name, value)
    rng = np.random.default_rng(4)
    text = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    passage, edge, under = text(400), text(250), text(150)
    docs = [(i, text(rng.integers(0, 300)) + passage[rng.integers(0, 60) :] + text(rng.integers(0, 300))) for i in range(25)]
    docs += [(30, edge), (31, edge), (32, under), (33, under), (34, None), (35, ""), (36, "a" * 900), (37, "ab" * 300)]
    docs += [(40, text(50) + edge + text(10) + edge), (41, passage[:199]), (42, text(3000))]
    same(spark, docs)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for _ in range(20):
        snippets = [bytes(rng.integers(97, 99, rng.integers(N, N + 40)).astype(np.uint8)) for _ in range(6)]
        snippets += [snippets[0][:N], b"a" * (N + 30), (snippets[1] + snippets[2])[5 : 5 + N]]
        text = np.frombuffer(b"".join(snippets), np.uint8)
        order, raw = s.suffix_array(text), b"".join(snippets) + b"\0" * 300
        assert [raw[i : i + N] for i in order] == sorted(raw[i : i + N] for i in range(len(text)))
        seen = defaultdict(int)
        for x in snippets:
            for i in range(len(x) - N + 1):
                seen[x[i : i + N]] += 1
        for x, flags in zip(snippets, s.repeated_windows(snippets), strict=True):
            assert flags.tolist() == [seen[x[i : i + N]] > 1 for i in range(len(x) - N + 1)]


def test_repeated_rows_and_nulls(spark):
    t = "".join(np.random.default_rng(9).choice(list("abcdef"), 300))
    df = spark.createDataFrame([(1, t), (1, t), (None, t + "x"), (None, "y")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in s.remove_repeats(df).collect())
    assert got == [(0, 1, 0), (0, 301, 300), (1, 300, 300), (1, 300, 300)]
    assert s.remove_repeats(df.limit(0)).count() == 0


def test_long_text_behind_empty_ones_is_split(monkeypatch):
    monkeypatch.setattr(s, "LONG_TEXT", 700)
    monkeypatch.setattr(s, "TEXT_BYTES", 500)
    texts = [b"", b"", b"x" * 3000, b"", b"y" * 100]
    found = [(data.size, owner.tolist()) for data, _, owner, _ in s._chunks(texts)]
    assert max(n for n, _ in found) <= 700 + N - 1
    assert {k for _, owner in found for k in owner} == set(range(5))
    assert sum(n for n, owner in found if owner == [2]) == 3000 + (N - 1) * 4


def test_thousands_of_equal_rows_cost_in_proportion(spark):
    """Each row once had the places of all its copies."""
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcdefgh "), 3300))
    df = spark.createDataFrame([(None, text)] * 3000 + [(1, text[:500]), (2, "other")], "doc_id long, text string")
    got = s.remove_repeats(df.repartition(8)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans): r["count"] for r in got} == {(None, 3300, 3300, 1): 3000, (1, 500, 500, 1): 1, (2, 5, 0, 0): 1}
