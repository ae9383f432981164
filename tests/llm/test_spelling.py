import re
import zlib
from collections import Counter

import numpy as np
import pytest

from faultloom.llm import spelling as s


def brute_words(docs, every):
    counts = Counter()
    for id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if every and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(words):
    """Words with form, root and counts; every pair with the same letters but two is looked at."""
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append((w, Counter(w)))
    out, form = {}, {}
    for w, n in words.items():
        own = Counter(w)
        some = [x for k in (-1, 0, 1) for x, c in by_length.get(len(w) + k, []) if ((own - c) + (c - own)).total() <= 2]
        found = [x for x in some if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
        out[w] = (form[w], n, len(found), words[best] if form[w] else None)
    roots = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        roots[w] = root
    return {w: (f, roots[w], n, k, fn) for w, (f, n, k, fn) in out.items()}


def same(rows, docs, every):
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    want = brute(brute_words(docs, every))
    assert got == want
    return want


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = same(s.variants(docs, misspell=199).collect(), [(r.doc_id, r.text) for r in docs.collect()], 199)
    assert len(want) > 500 and any(f for f, *_ in want.values())


def random_words(rng, n, alphabet="abc\u00e9"):
    return ["".join(rng.choice(list(alphabet), rng.integers(5, 10))) for _ in range(n)]


@pytest.mark.parametrize("crowd, block, queries", [(2048, 2048, 512), (2, 3, 1), (5, 40, 7)])
def test_dense_vocabulary(spark, monkeypatch, crowd, block, queries):
    """Few letters, so that most words have near words; chains of forms; keys split to the last letter."""
    for name, value in (("CROWD", crowd), ("BLOCK", block), ("QUERIES", queries)):
        monkeypatch.setattr(s, name, value)
    rng = np.random.default_rng(2)
    text = []
    for w in random_words(rng, 300):
        text += [w] * int(5 ** rng.integers(0, 5))
    rng.shuffle(text)
    docs = [(i, " ".join(text[i::9])) for i in range(9)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")
    want = same(s.variants(df, misspell=7).collect(), docs, 7)
    assert any(want[f][0] for f, *_ in want.values() if f)


def test_every_edit_of_a_word(spark):
    word = "tr\u00e9buchet"
    edits = {word[:k] + c + word[k + d :] for k in range(len(word) + 1) for c in ("", "a", "\u00ff", "t") for d in (0, 1)}
    edits = {e for e in edits if len(e) >= 6}
    docs = [(1, " ".join(e for e in sorted(edits) for _ in range(5))), (2, f"{word} " * 200)]
    same(s.variants(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs, None)


def test_nulls_marks_long_words_and_no_rows(spark):
    docs = [
        (None, "Letters letters_LETTERS 4letters,letter\u00d7letter"), (None, None), (3, ""), (4, "letters " * 9 + "lettrs" * 1),
        (5, "x" * 5000 + " "), (5, "x" * 5000), (5, "x" * 5000), (6, ("x" * 5000 + "\n") * 2), (7, ("x" * 4999 + " ") * 5),
        (8, "short \u00c9cole \u00e9cole " * 6), (9, "word\u0101word " * 6), (10, "\u212aelvin kelvin " * 6),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = same(s.variants(df, misspell=11).collect(), docs, 11)
    assert {len(w) for w in want if w[0] == "x"} <= {4999, 5000} and len(want) >= 3
    assert s.variants(df.limit(0)).count() == 0
