import re

import numpy as np
import pytest
import xxhash

from faultloom.llm import simhash as s


def brute_print(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")) if w]
    n = min(3, len(ws))
    hashes = [xxhash.xxh64(" ".join(ws[i : i + n]).encode(), seed=42).intdigest() for i in range(len(ws) - n + 1)] if n else []
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """id to the smallest id reachable, every pair of different fingerprints compared."""
    parent = {p: p for p in prints.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    different = np.array(sorted(parent), np.uint64)
    for k, p in enumerate(different):
        for q in different[k + 1 :][np.bitwise_count(different[k + 1 :] ^ p) <= 2]:
            parent[find(int(q))] = find(int(p))
    least = {}
    for d, p in prints.items():
        least[find(p)] = min(least.get(find(p), d), d)
    return {d: least[find(p)] for d, p in prints.items()}


def same(rows, docs):
    prints = {d: brute_print(t) for d, t in docs}
    want = brute_components(prints)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{p:016x}", want[d]) for d, p in prints.items()}


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = s.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    same(got, [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("crowd, step", [(16, 1 << 15), (1, 7)])
def test_families_and_edges(spark, monkeypatch, crowd, step):
    monkeypatch.setattr(s, "CROWD", crowd)
    monkeypatch.setattr(s, "STEP", step)
    rng = np.random.default_rng(3)
    docs = []
    for _ in range(5):
        base = [f"w{rng.integers(900)}" for _ in range(150)]
        for _ in range(40):
            own = list(base)
            for _ in range(rng.integers(0, 3)):
                own[rng.integers(len(own))] = f"w{rng.integers(900)}"
            docs.append(" ".join(own))
    docs += [None, "", " \n\t", "one", "ONE", "one two", "one\x0btwo ", "a b c", "A B c d", "É b c", "é b c", "x " * 5000, "x x x"]
    rows = [(i, t, 7, "n") for i, t in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, print int, fingerprint string")
    same(s.near_duplicates(df).collect(), [(i, t) for i, t, *_ in rows])


@pytest.mark.parametrize("crowd", [0, 3, 1000])
def test_links_by_blocks_and_by_neighbours(spark, monkeypatch, crowd):
    """Dense balls and chains around hot values, with every distance near the bound."""
    monkeypatch.setattr(s, "CROWD", crowd)
    rng = np.random.default_rng(5)
    found = {0, (1 << 64) - 1}
    for _ in range(6):
        middle = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(50):
            found.add(middle ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 4))}))
    prints = dict(enumerate(sorted(found)))
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints.values()], "print long")
    name = {int(np.uint64(p).astype(np.int64)): i for i, p in prints.items()}
    pairs = [(name[r.a], name[r.b]) for r in s.links(df).collect()]
    assert all(a != b and bin(prints[a] ^ prints[b]).count("1") <= 2 for a, b in pairs)
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {i: find(i) for i in prints} == brute_components(prints)


def test_many_near_copies_stay_linear(spark, monkeypatch):
    """A thousand fingerprints around one: rows of links stay in proportion to them."""
    rng = np.random.default_rng(9)
    ball = {sum({1 << int(b) for b in rng.integers(0, 64, 2)}) for _ in range(1500)}
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in ball], "print long")
    assert s.links(df).count() <= 65 * len(ball)


def test_null_ids_repeated_rows_and_no_rows(spark):
    df = spark.createDataFrame(
        [(None, "a b c"), (5, "a b c"), (5, "a b c"), (3, "a b c"), (5, "z y x w"), (9, None), (None, None), (None, "only here")],
        "doc_id long, text string",
    )
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in s.near_duplicates(df).collect())
    assert got == [(0, 0), (0, 0), (0, 0), (3, 3), (5, 3), (5, 3), (5, 5), (9, 9)]
    assert s.near_duplicates(df.limit(0)).count() == 0
