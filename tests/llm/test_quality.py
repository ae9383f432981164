import oracle
import pytest

from faultloom.llm import quality
from faultloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_words string"


def test_query_equals_sql(spark, sf_dir):
    q = QUERIES["op8_quality_rules"]
    assert oracle.compare(spark, "op8_quality_rules", q.run, q.oracle, sf_dir) is None


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {i + k for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), len(lines) - len(set(lines)), len(covered)


def test_edges(spark):
    texts = [None, "", " \t\n", "a " * 9, "x y\nx y\n\nx y", "the " * 5000, "é€ # < the", "  a b"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "a b", "clash"), (3, "a " * 9, "clash")]
    got = quality.quality(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for row, (_, text, _) in zip(got, rows, strict=True):
        assert (row.n_words, row.word_chars, row.n_dup_lines, row.n_repeat_words) == brute(text)
    assert quality.quality(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("kept, text", [
    (True, "the house of the man is in a town and it was for all that on the hill with the wind"),
    (False, "alpha beta gamma delta " * 2 + "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (False, "the### house### of### the### man### is### in### a### town and it was for all that on the hill with the wind"),
])
def test_rules(spark, kept, text):
    row = quality.quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not row.base_failed and row.kept is kept
