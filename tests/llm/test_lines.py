import numpy as np
import oracle

from faultloom.llm import lines
from faultloom.llm.queries import QUERIES


def near(a, b):
    """At most one word inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    """Equal lines of any length; one-edit partners among those of enough words."""
    seen, long, out = set(), [], {}
    for doc_id, text in sorted(docs):
        gone = []
        for i, line in enumerate((text or "").split("\n")):
            ws = line.split()
            if not ws:
                continue
            if tuple(ws) in seen or len(ws) >= lines.MIN_WORDS and any(near(ws, w) for w in long):
                gone.append(i)
            seen.add(tuple(ws))
            if len(ws) >= lines.MIN_WORDS:
                long.append(ws)
        out[doc_id] = gone
    return out


def test_query_equals_sql(spark, sf_dir):
    q = QUERIES["op6_line_dedup"]
    assert oracle.compare(spark, "op6", q.run, q.oracle, sf_dir) is None


def test_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    base = [[f"w{rng.integers(9)}" for _ in range(rng.integers(4, 9))] for _ in range(12)]
    docs = []
    for i in range(60):
        made = []
        for _ in range(3):
            ws = list(base[rng.integers(len(base))])
            for _ in range(rng.integers(0, 3)):
                at = rng.integers(len(ws) + 1)
                ws[at : at + rng.integers(0, 2)] = [f"w{rng.integers(9)}"] * rng.integers(0, 2)
            made.append(" \t".join(ws))
        docs.append((i, "\n".join(made)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "a b c d e " * 3000), (104, "a b c d e " * 3000)]
    df = spark.createDataFrame([(*d, 5, "x") for d in docs], "doc_id long, text string, n_chars int, line string")
    want = brute(docs)
    assert sum(map(len, want.values())) > 60
    got = {r.doc_id: r for r in lines.report(df).collect()}
    assert {d: r.removed_lines for d, r in got.items()} == {d: ",".join(map(str, g)) for d, g in want.items()}
    left = {r.doc_id: r for r in lines.filtered(df).collect()}
    assert len(left) == len(docs)
    for doc_id, text in docs:
        if not want[doc_id]:
            assert (left[doc_id].text, left[doc_id].n_chars) == (text, 5)
        else:
            kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in want[doc_id])
            assert (left[doc_id].text, left[doc_id].n_chars) == (kept, len(kept))
    assert lines.filtered(df).schema == df.schema


def test_nulls_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e\nz"), (1, "a b c d e\nz"), (0, "b c d e f g"), (2, "z\n\nZ")], "doc_id long, text string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.removed_lines) for r in lines.report(df).collect())
    assert got == [(False, 0, ""), (True, 0, ""), (True, 1, "0"), (True, 1, "0"), (True, 2, "0")]
    assert lines.report(df.limit(0)).count() == 0
    only = df.filter("doc_id = 1")
    assert {r.removed_lines for r in lines.report(only).collect()} == {""}


def test_short_lines_and_scripts_without_spaces(spark):
    """Equal lines go whatever their length, near ones only from MIN_WORDS on."""
    texts = ["All rights reserved.\nLes.\n-", "Les.\nAll rights  reserved.\nAll rights kept.", "- \n\u4e2d\u6587\u53e5\u5b50\n\n", "\u4e2d\u6587\u53e5\u5b50\n\u4e2d\u6587\u53e5\u5b51\n\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.removed_lines for r in lines.report(df).collect()}
    assert got == {0: "", 1: "0,1", 2: "0", 3: "0"}


def test_variant_keys_and_one_very_long_line(spark):
    """Keys equal those of the rests; a line of 40,000 words costs no more than its words."""
    rows = [([f"w{i % 7}" for i in range(n)],) for n in (1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 70)]
    df = spark.createDataFrame(rows, "ws array<string>")
    for r in df.select("ws", lines.variant_keys(lines.F.col("ws")).alias("k")).collect():
        rests = [(r.ws[:i] + r.ws[i + 1 :],) for i in range(len(r.ws))]
        want = spark.createDataFrame([(r.ws,), *rests], "ws array<string>").select(lines.variant_keys(lines.F.col("ws"))[0]).collect()
        assert r.k == [w[0] for w in want]
    long = " ".join(f"x{i}" for i in range(40_000))
    docs = [(1, long), (2, long.replace("x777 ", "")), (3, long + " more"), (4, long.replace("x5 ", "").replace("x9 ", ""))]
    got = lines.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_removed, r.n_near) for r in got} == {1: (0, 0), 2: (1, 1), 3: (1, 1), 4: (0, 0)}


def test_columns_of_other_meaning_stay(spark):
    names = ["removed", "_id", "_version", "removed_from", "Removed_Lines", "n_chars"]
    rows = [(i, "same five words in line\nand another of them here", *["v"] * 5, 9) for i in range(2)]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names[:-1]), "n_chars int"]))
    got = sorted(tuple(r) for r in lines.filtered(df).collect())
    assert got == [rows[0], (1, "", *["v"] * 5, 0)]
