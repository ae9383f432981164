import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultloom.operators import linking
from faultloom.schemas import CROSS_LINKS
from faultloom.sources.records import CORPORA, load_records, read_traces, trace_records

STOP = ("the", "of")


def brute_force(issues, records, threshold, max_share=0.9, stop=STOP):
    """Every pair, compared in full."""
    texts = [t for _, t in issues] + [t for _, t in records]
    counts = []
    for text in texts:
        words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in stop]
        counts.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    n, df = len(texts), Counter(term for c in counts for term in c)
    vectors = []
    for c in counts:
        v = {
            t: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[t])) + 1)
            for t, k in c.items()
            if df[t] <= max_share * n
        }
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / norm for t, w in v.items()})
    out = {}
    for i, (node_id, _) in enumerate(issues):
        for j, (record_id, _) in enumerate(records):
            a, b = vectors[i], vectors[len(issues) + j]
            score = sum(w * b.get(t, 0.0) for t, w in a.items())
            if score >= threshold:
                out[node_id, record_id] = score
    return out


def frames(spark, issues, records):
    left = spark.createDataFrame(issues, "node_id string, text string")
    right = spark.createDataFrame(records, "external_id string, text string")
    return left, right.withColumn("corpus_id", F.lit("mast"))


def linked(spark, issues, records, threshold, **options):
    left, right = frames(spark, issues, records)
    links = linking.link_texts(left, right, threshold=threshold, stop_words=STOP, **options)
    return {(r.node_id, r.external_id): r.similarity for r in links.collect()}


WORDS = ["agent", "loop", "crash", "tool", "retry", "the", "planner", "memory", "x1", "état"]
text = st.lists(st.sampled_from(WORDS), min_size=0, max_size=12).map(" ".join)


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(text, min_size=1, max_size=8),
    st.lists(text, min_size=1, max_size=5),
    st.sampled_from([0.02, 0.1, 0.3, 0.7]),
)
def test_links_equal_brute_force(spark, issue_texts, record_texts, threshold):
    issues = [(f"n{i}", t) for i, t in enumerate(issue_texts)]
    records = [(f"r{i}", t) for i, t in enumerate(record_texts)]
    want = brute_force(issues, records, threshold)
    close = {k for k, v in brute_force(issues, records, 1e-9).items() if abs(v - threshold) < 1e-9}
    found = linked(spark, issues, records, threshold)
    assert set(found) - close == set(want) - close
    for pair in set(found) & set(want):
        assert math.isclose(found[pair], want[pair], abs_tol=1e-9)


def test_a_crowd_of_copies_is_linked_in_full(spark):
    copies = [(f"c{i}", "planner retry crash loop memory") for i in range(60)]
    others = [(f"o{i}", f"agent number{i} tool{i} state{i}") for i in range(100)]
    records = [("r0", "planner retry crash loop memory"), ("r1", "planner retry crash loop memory"), ("r2", "agent tool3")]
    issues = copies + others
    assert linked(spark, issues, records, 0.1).keys() == brute_force(issues, records, 0.1).keys()
    left, right = frames(spark, issues, records)
    assert linking._texts(left, right).distinct.count() == 102


def test_hot_terms_take_the_salted_way(spark, monkeypatch):
    monkeypatch.setattr(linking, "_HOT_TERMS", 40)
    monkeypatch.setattr(linking, "_SALTS", 4)
    issues = [(f"n{i}", f"common words{i % 7} planner step{i}") for i in range(40)]
    records = [(f"r{i}", f"common planner step{i} words{i}") for i in range(6)]
    found = linked(spark, issues, records, 0.05)
    want = brute_force(issues, records, 0.05)
    assert found.keys() == want.keys()
    assert all(math.isclose(found[k], want[k], abs_tol=1e-9) for k in want)


def test_related_record_is_linked(spark):
    issues = [("n1", "crewai Agent loops forever when tool raises on retry the agent repeats the call"),
              ("n2", "crewai Documentation typo on page")]
    records = [("rel", "agent loops forever repeating the same tool call on retry"),
               ("far", "quarterly revenue of bakery chains in alpine towns")]
    found = linked(spark, issues, records, 0.05)
    assert set(found) == {("n1", "rel")} and 0.05 <= found["n1", "rel"] <= 1.0


def test_nothing_to_link(spark):
    assert linked(spark, [("n", "alpha beta")], [("r", "gamma delta"), ("s", "alpha zeta")], 0.99) == {}
    assert linked(spark, [("n", "the")], [("r", "of")], 0.1) == {}
    left, right = frames(spark, [("n", "alpha")], [("r", "alpha")])
    assert linking.link_texts(left.limit(0), right, stop_words=STOP).count() == 0
    links = linking.link_texts(left, right.limit(0), stop_words=STOP)
    assert links.count() == 0 and links.columns == CROSS_LINKS.names
    with pytest.raises(ValueError):
        linking.link_texts(left, right, threshold=0.0)


def test_default_stop_words(spark):
    assert {"the", "of", "and"} <= set(linking.english_stop_words())


def test_traces(spark, tmp_path):
    path = tmp_path / "traces.json"
    path.write_text(
        '[{"round": 1, "mas_name": "M", "benchmark_name": "B", "trace_id": 7, "trace": "body \\n",'
        ' "annotations": [{"failure mode": "1.1 one\\ntwo"}, {"failure mode": "2.2"}]},'
        ' {"mas_name": "M", "trace": " t"}]'
    )
    one, two = trace_records(read_traces(spark, str(path))).collect()
    assert one.external_id == "1-M-7" and one.text == "M B 1.1 one | 2.2 body"
    assert one.title == "MAST trace: M on B" and one.corpus_id == "mast"
    assert two.external_id == "-M-" and two.text == "M    t"


def test_failing_and_missing_loaders_are_skipped(spark):
    def broken(session):
        return read_traces(session, "/nowhere/at/all.json")

    def good(session):
        return session.createDataFrame([("agent_error", "1", "t", "x")], "corpus_id string, external_id string, title string, text string")

    records = load_records(spark, {"mast": broken, "agent_error": good})
    assert [r.corpus_id for r in records.collect()] == ["agent_error"]
    assert load_records(spark, {"mast": broken}).count() == 0
    assert load_records(spark, {}).count() == 0
    assert len(CORPORA) == 5


def test_sweep_and_top(spark):
    links = spark.createDataFrame(
        [("n1", "mast", "r1", 0.5, "semantic"), ("n2", "mast", "r1", 0.1, "semantic"), ("n3", "mast", "r2", 0.1, "semantic")],
        CROSS_LINKS,
    )
    assert {r.threshold: r.n_links for r in linking.links_at(links, [0.1, 0.2]).collect()} == {0.1: 3, 0.2: 1}
    assert [r.node_id for r in linking.top_links(links, 2).collect()] == ["n1", "n2"]
    issues = spark.createDataFrame([("n1", "a"), ("n2", "b")], "node_id string, framework_slug string")
    row = linking.links_per_record(links, issues).first()
    assert (row.n_issues, row.n_frameworks, row.best_similarity) == (2, 2, 0.5)
    assert linking.linked_issues(issues, links.filter("similarity > 0.2")).count() == 1


def test_pairs_with_one_weak_common_term_do_not_survive(spark, monkeypatch):
    """Survivors are added up term by term, so few but the links may be among them."""
    words = [f"w{i}" for i in range(400)]
    issues = [(f"n{i}", " ".join(words[(i * 37 + j * (j + i % 7)) % 400] for j in range(60))) for i in range(60)]
    records = [(f"r{i}", " ".join(words[(i * 53 + j * (j + 3)) % 400] for j in range(60))) for i in range(20)]
    records.append(("copy", issues[5][1]))
    left, right = frames(spark, issues, records)
    texts = linking._texts(left, right)
    vectors = linking.materialize(linking._vectors(linking._weighted_terms(texts, STOP, 0.9)), "vectors")
    few = linking._survivors(vectors, 0.3)[0].count()
    monkeypatch.setattr(linking, "_REST", 1.0)
    many = linking._survivors(vectors, 0.3)[0].count()
    monkeypatch.undo()
    want = brute_force(issues, records, 0.3)
    assert 0 < len(want) <= few < many / 3
    got = linked(spark, issues, records, 0.3)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)


def test_without_records_nothing_is_tokenised(spark, monkeypatch):
    def fails(*_):
        raise AssertionError("terms of issues were made")

    monkeypatch.setattr(linking, "materialize", fails)
    issues, records = frames(spark, [("n1", "memory error in loop")], [("r1", None)])
    assert linking.link_texts(issues, records).columns == CROSS_LINKS.names
    assert linking.link_texts(issues, records.limit(0)).count() == 0


def test_issues_far_from_every_record_go_before_frequencies_are_counted(spark, monkeypatch):
    """Only candidates and records are weighted; links are those of all texts, also where hashes bound badly."""
    issues = [(f"n{i}", " ".join(f"w{i}x{j}" for j in range(40)) + f" common{i % 3} planner") for i in range(50)]
    issues += [("copy", "planner retry crash common1 loop"), ("near", "retry crash somewhere else common2")]
    records = [("r0", "planner retry crash loop"), ("r1", "quarterly revenue of chains common1")]
    want = brute_force(issues, records, 0.2)
    weighted, filtered = linking._weighted_terms, []

    def seen(*args):
        out = weighted(*args)
        filtered.append(out.select("text_id").distinct().count())
        return out

    monkeypatch.setattr(linking, "_weighted_terms", seen)
    for limits, most in (({}, 10), ({"_HASHES": 1, "_FILTER_WORDS": 1, "_BROADCAST_IDS": 0}, 54)):
        for name, value in limits.items():
            monkeypatch.setattr(linking, name, value)
        got = linked(spark, issues, records, 0.2)
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k]) for k in want)
        assert filtered[-1] <= most
    monkeypatch.setattr(linking, "_BROADCAST_TERMS", 3)
    got = linked(spark, issues, records, 0.2)
    assert got.keys() == want.keys() and filtered[-1] == 54
