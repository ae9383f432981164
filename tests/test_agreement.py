import json
import math
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException

from faultloom.operators import agreement
from faultloom.schemas import AXES

CONSTANT = {"locus": "agent", "phase": "action", "symptom": "loop", "root_cause": "api_misuse"}


def labels(spark, rows):
    """Rows of (node_id, overrides)."""
    data = [(node_id, *[{**CONSTANT, **over}[a] for a in AXES]) for node_id, over in rows]
    return spark.createDataFrame(data, "node_id string, " + ", ".join(f"{a} string" for a in AXES))


def kappa(pairs):
    """Cohen's kappa from its definition."""
    n = len(pairs)
    observed = sum(a == b for a, b in pairs) / n
    left, right = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    expected = sum(left[k] / n * (right[k] / n) for k in left)
    return None if expected == 1 else (observed - expected) / (1 - expected)


def test_identical_tables(spark):
    rows = [(f"n{i}", {"locus": "agent" if i % 2 else "model"}) for i in range(20)]
    rows = [(k, {**v, "phase": "action" if i % 2 else "infra", "symptom": "loop" if i % 2 else "crash", "root_cause": "api_misuse" if i % 2 else "unknown"}) for i, (k, v) in enumerate(rows)]
    report = agreement.collect_report(agreement.kappa_report(labels(spark, rows), labels(spark, rows)))
    assert report["n"] == 20 and report["mean_kappa"] == 1.0
    for axis in AXES:
        assert report["per_axis"][axis] == {"kappa": 1.0, "agreement_count": 20, "agreement_rate": 1.0}
        assert report["summary"][axis] == "κ=1.000, agreement=20/20"


def test_flipped_labels_and_undefined_axes(spark):
    a = labels(spark, [(f"n{i}", {"locus": "agent" if i < 10 else "model"}) for i in range(20)])
    b = labels(spark, [(f"n{i}", {"locus": "model" if i < 10 else "agent"}) for i in range(20)])
    report = {r.axis: r for r in agreement.kappa_report(a, b).collect()}
    assert report["locus"].kappa == -1.0 and report["locus"].agreement_count == 0
    assert report["phase"].kappa is None and report["phase"].agreement_count == 20
    assert agreement.mean_kappa(agreement.kappa_report(a, b)).first().mean_kappa is None
    skipped = agreement.mean_kappa(agreement.kappa_report(a, b), "skip").first()
    assert skipped.mean_kappa == -1.0


def test_partial_agreement(spark):
    a = labels(spark, [(f"n{i}", {"locus": "agent" if i < 10 else "model"}) for i in range(20)])
    b = labels(spark, [(f"n{i}", {"locus": "agent" if i < 7 else "model"}) for i in range(20)])
    row = agreement.kappa_report(a, b, ("locus",)).first()
    assert row.agreement_count == 17 and math.isclose(row.kappa, 0.70)


def test_only_shared_keys_count(spark):
    a, b = (labels(spark, [(f"n{i}", {}) for i in r]) for r in (range(1, 4), range(2, 5)))
    assert {r.n for r in agreement.kappa_report(a, b).collect()} == {2}


def test_no_overlap_is_an_error(spark):
    a, b = (labels(spark, [(k, {})]) for k in ("x", "y"))
    with pytest.raises(PySparkException, match="No overlapping"):
        agreement.kappa_report(a, b).collect()
    assert agreement.kappa_report(a, b, require_overlap=False).count() == 0


def test_repeated_keys_multiply(spark):
    """A key that is hot on both sides counts every pair of its rows."""
    rng = random.Random(3)
    pick = lambda: {"locus": rng.choice(["agent", "model", None])}
    rows_a = [("hot" if i % 3 == 0 else f"n{i % 40}", pick()) for i in range(120)]
    rows_b = [("hot" if i % 3 == 0 else f"n{i % 30}", pick()) for i in range(90)]
    pairs = [(x["locus"], y["locus"]) for k, x in rows_a for m, y in rows_b if k == m]
    row = agreement.kappa_report(labels(spark, rows_a), labels(spark, rows_b), ("locus",)).first()
    assert row.n == len(pairs)
    assert row.agreement_count == sum(a == b for a, b in pairs)
    assert math.isclose(row.kappa, kappa(pairs), abs_tol=1e-12)
    # The hot key is joined as a handful of weighted rows.
    joined = agreement.join_labels([labels(spark, rows_a), labels(spark, rows_b)], ("locus",))
    assert joined.filter("node_id = 'hot'").count() <= 9


def test_pairwise_equals_two_table_reports(spark):
    rng = random.Random(5)
    tables = {
        name: labels(spark, [(f"n{i % 50}", {"symptom": rng.choice(["loop", "crash"])}) for i in range(60)])
        for name in ("a", "b", "c")
    }
    found = {
        (r.annotator_a, r.annotator_b, r.axis): (r.n, r.agreement_count, r.kappa)
        for r in agreement.pairwise_kappa(agreement.annotations(tables)).collect()
    }
    for x, y in (("a", "b"), ("a", "c"), ("b", "c")):
        for r in agreement.kappa_report(tables[x], tables[y]).collect():
            n, agreed, value = found[(x, y, r.axis)]
            assert (n, agreed) == (r.n, r.agreement_count)
            assert value == r.kappa or math.isclose(value, r.kappa, abs_tol=1e-12)


# Published consensus counts: n, pair agrees, third confirms, share of all three in per cent.
PUBLISHED = {
    "locus": (495, 416, 397, 80.2),
    "symptom": (495, 443, 413, 83.4),
    "root_cause": (495, 286, 245, 49.5),
    "phase": (495, 369, 314, 63.4),
}


@pytest.mark.parametrize("axis", PUBLISHED)
def test_published_consensus(spark, axis):
    n, pair, confirmed, share = PUBLISHED[axis]
    table = lambda f: labels(spark, [(f"n{i}", {axis: f(i)}) for i in range(n)])
    a = table(lambda i: "x")
    b = table(lambda i: "x" if i < pair else "y")
    c = table(lambda i: "x" if i < confirmed else "z")
    row = agreement.consensus(a, b, c, (axis,)).first()
    assert (row.n, row.pair_agrees, row.third_confirms) == (n, pair, confirmed)
    assert round(100 * row.all_three_rate, 1) == share


def test_drift(spark):
    a = labels(spark, [(f"n{i}", {}) for i in range(4)])
    b = labels(spark, [("n0", {"locus": "model"}), ("n1", {}), ("n2", {"locus": "model", "phase": "infra"}), ("zz", {})])
    found = {(r.node_id, r.axis, r.stored, r.audit) for r in agreement.disagreements(a, b).collect()}
    assert found == {
        ("n0", "locus", "agent", "model"),
        ("n2", "locus", "agent", "model"),
        ("n2", "phase", "action", "infra"),
    }
    summary = agreement.drift_summary(a, b).first()
    assert summary.sample_size == 3 and math.isclose(summary.agreement, 1 / 3)
    nothing = agreement.drift_summary(a, b.filter("node_id = 'zz'")).first()
    assert (nothing.sample_size, nothing.agreement) == (0, 0.0)


def test_report_sink(spark, tmp_path):
    a = labels(spark, [("n1", {}), ("n2", {"locus": "model"})])
    agreement.report_json(agreement.kappa_report(a, a)).write.text(str(tmp_path / "r"))
    rows = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert {r["axis"] for r in rows} == set(AXES)
