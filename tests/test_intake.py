import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from faultloom.operators import intake
from faultloom.schemas import RAW_ISSUE, conform
from faultloom.sources import payloads


def raw(spark, rows, schema):
    return conform(spark.createDataFrame(rows, schema), RAW_ISSUE)


CASES = [
    # labels, title, pull request, kept
    ([], "Fix infinite loop", True, False),
    (["enhancement"], "Add support for streaming tool responses", False, False),
    (["type:bug", "priority:high"], "Agent loops forever when tool raises on retry", False, True),
    ([], "crash on startup", False, True),
    ([], "something odd", False, True),
    (["enhancement", "type:bug"], "odd", False, True),
    (["enhancement"], "crash in parser", False, False),
    (["priority:high"], "odd", False, False),
    (["priority:high"], "CRASH in parser", False, True),
    (["Debug-Tools"], "odd", False, True),
    (None, None, False, True),
    (["priority:high"], None, False, False),
]


def test_failure_test_decision_order(spark):
    rows = [(str(i), *case) for i, case in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "i string, labels array<string>, title string, pr boolean, kept boolean"
    )
    test = intake.looks_like_failure(F.col("title"), F.col("labels"), F.col("pr"))
    assert df.filter(test != F.col("kept")).collect() == []
    assert df.filter(test.isNull()).count() == 0


def test_term_lists_are_arguments(spark):
    df = raw(spark, [("a", "zonk in parser", ["x"], False)], "node_id string, title string, labels array<string>, is_pull_request boolean")
    assert intake.keep_failures(df).count() == 0
    assert intake.keep_failures(df, intake.FailureTerms(title=("zonk",))).count() == 1


def payload(**over):
    base = {
        "number": 1,
        "node_id": "I_1",
        "title": "Agent loops",
        "body": "b",
        "html_url": "https://github.com/langchain-ai/langchain/issues/1",
        "labels": [{"name": "type:bug"}],
        "state": "open",
        "created_at": "2026-03-10T09:30:00Z",
        "updated_at": "2026-03-11T09:30:00+02:00",
        "closed_at": None,
        "comments": 4,
    }
    base.update(over)
    return {k: v for k, v in base.items() if v != "ABSENT"}


@pytest.fixture
def landing(tmp_path):
    def write(*records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (tmp_path / "a.json").write_text("\n".join(lines))
        return str(tmp_path)

    return write


def test_payload_typing(spark, landing):
    path = landing(
        payload(),
        payload(node_id="I_2", comments="ABSENT", author_association="MEMBER", labels="ABSENT"),
        payload(node_id="I_3", closed_at="2026-03-12T00:00:00Z", state="closed"),
    )
    rows = {
        r.node_id: r
        for r in payloads.good_rows(
            payloads.type_payloads(payloads.read_landing(spark, path))
        ).collect()
    }
    assert rows["I_1"].framework_slug == "langchain"
    assert rows["I_1"].labels == ["type:bug"]
    assert rows["I_1"].created_at.replace(tzinfo=UTC) == datetime(2026, 3, 10, 9, 30, tzinfo=UTC)
    assert rows["I_1"].updated_at.replace(tzinfo=UTC) == datetime(2026, 3, 11, 7, 30, tzinfo=UTC)
    assert rows["I_1"].closed_at is None and rows["I_1"].comment_count == 4
    assert rows["I_2"].comment_count == 0 and rows["I_2"].labels == []
    assert rows["I_2"].author_association == "MEMBER"
    assert rows["I_3"].closed_at is not None


def test_pull_request_is_key_presence(spark, landing):
    path = landing(payload(pull_request=None), payload(node_id="I_2", pull_request={"url": "u"}), payload(node_id="I_3"))
    rows = payloads.good_rows(payloads.type_payloads(payloads.read_landing(spark, path)))
    found = {r.node_id: r.is_pull_request for r in rows.collect()}
    assert found == {"I_1": True, "I_2": True, "I_3": False}


def test_bad_payloads_are_set_aside(spark, landing):
    path = landing(
        payload(),
        "{broken",
        payload(node_id="ABSENT"),
        payload(title=None),
        payload(state="odd"),
        payload(created_at="yesterday"),
        payload(closed_at="later"),
        payload(html_url="https://github.com/some/other/issues/1"),
        payload(labels=[{"name": None}]),
    )
    typed = payloads.type_payloads(payloads.read_landing(spark, path))
    assert payloads.good_rows(typed).count() == 1
    assert sorted(r.problem for r in payloads.quarantine(typed).collect()) == [
        "bad closed_at",
        "bad created_at",
        "label without name",
        "malformed JSON",
        "missing node_id",
        "missing title",
        "unknown repository",
        "unknown state",
    ]


def test_scan_keeps_one_of_bug_feature_and_pull_request(spark, landing):
    path = landing(
        payload(),
        payload(node_id="I_2", labels=[{"name": "enhancement"}], title="Add support"),
        payload(node_id="I_3", labels=[], pull_request={"url": "u"}),
    )
    typed = payloads.good_rows(payloads.type_payloads(payloads.read_landing(spark, path)))
    assert [r.node_id for r in intake.keep_failures(typed).collect()] == ["I_1"]


def stream(spark, n=400):
    return (
        spark.range(n)
        .select(
            F.concat(F.lit("n"), F.col("id").cast("string")).alias("node_id"),
            F.col("id").alias("issue_number"),
            # one framework holds most rows
            F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.lit("cold")).alias("framework_slug"),
            F.timestamp_seconds(F.col("id") % 97 * 1000).alias("updated_at"),
        )
    )


@pytest.mark.parametrize("cap", [1, 7, 200])
def test_cap_two_stage_equals_plain_ranking(spark, cap):
    rows = stream(spark)
    want = set()
    by = {}
    for r in rows.collect():
        by.setdefault(r.framework_slug, []).append(r)
    for group in by.values():
        group.sort(key=lambda r: (r.updated_at, r.issue_number), reverse=True)
        want |= {r.node_id for r in group[:cap]}
    one = {r.node_id for r in intake.cap_per_framework(rows, cap).collect()}
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "0")
        two = {r.node_id for r in intake.cap_per_framework(rows, cap, salts=8).collect()}
    finally:
        spark.conf.set(limit, before)
    assert one == want and two == want


@pytest.mark.parametrize("cap", [0, None])
def test_no_cap(spark, cap):
    assert intake.cap_per_framework(stream(spark), cap).count() == 400


def test_cap_is_cut_before_the_shuffle(spark):
    plan = intake.cap_per_framework(stream(spark), 10)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_cursor_is_inclusive_and_missing_cursor_keeps_all(spark):
    rows = stream(spark)
    mark = rows.filter("issue_number = 50").select(
        F.lit("hot").alias("slug"), F.col("updated_at").alias("last_scraped_at")
    )
    kept = intake.since_cursor(rows, mark)
    assert kept.filter("framework_slug = 'cold'").count() == 80
    at = mark.first().last_scraped_at
    hot = kept.filter("framework_slug = 'hot'").collect()
    assert min(r.updated_at for r in hot) == at


def test_unknown_framework_is_an_error(spark):
    with pytest.raises(ValueError, match="Unknown framework slug"):
        intake.only_framework(stream(spark), "nope")
    assert intake.only_framework(stream(spark), "cold", known=("cold", "hot")).count() == 80


def test_state_filter(spark):
    df = spark.createDataFrame([("open",), ("closed",), ("open",)], "state string")
    assert intake.with_state(df, "open").count() == 2
    assert intake.with_state(df, "all").count() == 3
    with pytest.raises(ValueError):
        intake.with_state(df, "ajar")
