import re

import numpy as np
import pytest

from faultloom.llm import minhash as m
from faultloom.llm.components import connected_components


def brute(docs, words, percent):
    """doc_id to (n_shingles, component_id), every pair compared."""
    sets = {}
    for doc_id, text in docs:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")) if w]
        n = min(words, len(ws))
        sets[doc_id] = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = len(sets[a]), len(sets[b])
            if min(x, y) * 100 < max(x, y) * percent:
                continue
            common = len(sets[a] & sets[b])
            if common * 100 >= (x + y - common) * percent:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def same(rows, docs, words, percent):
    want = brute(docs, words, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    same(m.dedup_documents(docs, 3, 85).collect(), pairs, 3, 85)


@pytest.mark.parametrize("block, few, columns", [(4, 2000, 4096), (512, 0, 7), (16, 3, 64)])
def test_families_and_edges(spark, monkeypatch, block, few, columns):
    for name, value in (("BLOCK", block), ("FEW_PAIRS", few), ("COLUMNS", columns)):
        monkeypatch.setattr(m, name, value)
    rng = np.random.default_rng(1)
    word = lambda: f"w{rng.integers(5000)}"
    docs = []
    for family in range(6):
        base = [word() for _ in range(80)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.integers(0, 10)):
                own[rng.integers(len(own))] = word()
            docs.append(" ".join(own))
    docs += [None, "", " \n", "one", "ONE", "one two", "one  two\t", "a b c", "É b c", "é b c", "x " * 5000]
    rows = [(i, t, "n") for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    same(m.dedup_documents(df, 3, 85).collect(), [(i, t) for i, t, _ in rows], 3, 85)
    kept = m.filtered(df, 3, 85)
    want = brute([(i, t) for i, t, _ in rows], 3, 85)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (3, "a b c"), (5, "z y x")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in m.dedup_documents(df, 3, 85).collect())
    assert got == [(0, 0, True), (3, 3, True), (5, 3, False), (5, 3, False), (5, 5, True)]
    assert m.dedup_documents(df.limit(0), 3, 85).count() == 0
    assert m.filtered(df).count() == 3


def test_posterior_bound_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (200_000, m.HASHES)).astype(np.uint8)
    b = np.where(rng.random(a.shape) < 0.85, a, a + 1).astype(np.uint8)
    assert (m.sequential(a, b, 85) < 0).mean() < 1e-4
    far = np.where(rng.random(a.shape) < 0.4, a, a + 1).astype(np.uint8)
    assert (m.sequential(a, far, 85) < 0).mean() > 0.99


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, **{i: 100 for i in range(101, 160)}, 200: 199}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_common_elements_by_product():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    i, j = np.triu_indices(30, 1)
    want = [len(set(sets[a].tolist()) & set(sets[b].tolist())) for a, b in zip(i, j, strict=True)]
    for few in (0, 10_000):
        m.FEW_PAIRS, before = few, m.FEW_PAIRS
        try:
            assert m._common(sets, i, j).tolist() == want
        finally:
            m.FEW_PAIRS = before


def test_columns_of_other_meaning_stay(spark):
    names = ["_id", "_version", "version", "copy_id", "Copy_Version", "node", "kept"]
    rows = [(i, f"a b c d e f {i // 2}", *["v"] * len(names)) for i in range(4)]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)]))
    assert sorted(tuple(r) for r in m.filtered(df, 3, 85).collect()) == [rows[0], rows[2]]


def test_a_star_and_a_hub_that_is_not_the_least(spark):
    """Two nodes with nearly all links, one of them their component's largest; joined by broadcast, whatever their share."""
    star = [(0, i) for i in range(1, 20_000)] + [(99_999, i) for i in range(30_000, 50_000)] + [(60_000 + i, 60_001 + i) for i in range(9)]
    df = spark.createDataFrame(star, "a long, b long")
    roots = connected_components(df).groupBy("root").count().collect()
    assert {r.root: r["count"] for r in roots} == {0: 19_999, 30_000: 20_000, 60_000: 9}
