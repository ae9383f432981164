import hashlib
import json

import pytest
from pyspark.sql import functions as F

from faultloom import dims
from faultloom.functions.text import WHITESPACE, strip
from faultloom.functions.time import revision_tag
from faultloom.operators import labelling, rows, validation
from faultloom.plans.queries import QUERIES
from faultloom.schemas import (
    AXES,
    CROSS_LINKS,
    DOMAINS,
    ISSUES,
    LABELS,
    RAW_ISSUE,
    conform,
    empty,
)


@pytest.fixture
def one(spark):
    def make(**over):
        base = {
            "framework_slug": "crewai",
            "issue_number": 7,
            "node_id": "n7",
            "title": "T",
            "body": "B",
            "url": "u",
            "labels": ["bug", "p1"],
            "state": "open",
            "is_pull_request": False,
            "comment_count": 1,
        }
        base.update(over)
        fields = [f for f in RAW_ISSUE if f.name in base]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        return conform(
            spark.createDataFrame([tuple(base[f.name] for f in fields)], schema), RAW_ISSUE
        )

    return make


def test_strip_takes_every_white_space(spark):
    df = spark.createDataFrame([(WHITESPACE + "a" + WHITESPACE + "b" + WHITESPACE,)], "x string")
    text = df.select(strip(F.col("x"))).first()[0]
    assert text == (WHITESPACE + "a" + WHITESPACE + "b" + WHITESPACE).strip()


def test_prompt_layout(one):
    text = rows.prompts(one()).first().prompt
    assert text == (
        "Framework: crewai\nIssue #7 (open)\nLabels: bug, p1\nURL: u\n\nTitle: T\n\nBody:\nB"
    )


@pytest.mark.parametrize(
    ("body", "labels", "end"),
    [
        (None, [], "(empty)"),
        (" \n\t", None, "(empty)"),
        ("x" * 4000, [], "x" * 4000),
        ("x" * 5000, [], "x" * 4000 + "\n\n[truncated]"),
        ("é" * 4001, [], "é" * 4000 + "\n\n[truncated]"),
    ],
)
def test_prompt_body(one, body, labels, end):
    text = rows.prompts(one(body=body, labels=labels)).first().prompt
    assert text.split("Body:\n")[1] == end
    assert "Labels: (none)\n" in text


def test_taxonomy_prompt_is_stable_and_complete():
    text = dims.taxonomy_prompt()
    assert text == dims.taxonomy_prompt()
    for axis, labels in DOMAINS.items():
        assert f"## Axis: {axis} (" in text
        for label in labels:
            assert f"- **{label}**: " in text
    assert dims.system_prompt().startswith(text)


def test_dimensions(spark):
    taxonomy = dims.taxonomy(spark)
    assert taxonomy.count() == 28
    assert taxonomy.filter("definition = '' OR definition IS NULL").count() == 0
    assert validation.check_axes(taxonomy).filter("NOT valid").count() == 0
    found = {(r.axis, r.label) for r in taxonomy.collect()}
    assert found == {(axis, label) for axis, labels in DOMAINS.items() for label in labels}
    frameworks = dims.frameworks(spark).collect()
    assert len(frameworks) == 12 and [f.slug for f in frameworks] == sorted(f.slug for f in frameworks)


def test_unknown_axis_is_invalid(spark):
    df = spark.createDataFrame([("mood", "crash"), ("symptom", "crash")], "axis string, label string")
    assert {r.axis: r.valid for r in validation.check_axes(df).collect()} == {
        "mood": False,
        "symptom": True,
    }


@pytest.mark.parametrize(
    ("day", "tag"),
    [("2027-01-01", "2026-W53"), ("2026-04-24", "2026-W17"), ("2024-12-30", "2025-W01")],
)
def test_revision_tag(spark, day, tag):
    assert spark.range(1).select(revision_tag(F.lit(day).cast("timestamp"))).first()[0] == tag


def test_compose_and_back(spark, one):
    labels = rows.dry_run_labels(one())
    issue = rows.issue_rows(one(), labels, tier="dry_run", model="dry-run")
    assert issue.columns == ISSUES.names
    row = issue.first()
    assert row.locus == "unknown" and row.confidence == 0.0 and row.needs_review
    direct = rows.dry_run_issues(one()).first()
    assert row.asDict() | {"classified_at": 0} == direct.asDict() | {"classified_at": 0}
    nothing = issue.withColumn("labels", F.lit(None).cast("array<string>"))
    assert rows.raw_from_issues(nothing).first().labels == []
    assert rows.match_texts(issue).first().text == "crewai T B"


def test_empty_frames_keep_their_schema(spark, tmp_path):
    path = str(tmp_path / "links")
    empty(spark, CROSS_LINKS).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.count() == 0 and back.columns == CROSS_LINKS.names


GOOD = {
    "node_id": "n", "locus": "agent", "phase": "action", "symptom": "loop",
    "root_cause": "api_misuse", "confidence": 0.92, "reasoning": "r", "needs_review": False,
}


@pytest.mark.parametrize(
    ("change", "problems"),
    [
        ({}, []),
        ({"confidence": 0.0}, []),
        ({"confidence": 1.0}, []),
        ({"confidence": 1.5}, [validation.CONFIDENCE_RANGE]),
        ({"confidence": float("nan")}, [validation.CONFIDENCE_RANGE]),
        ({"locus": "gremlin"}, [validation.INVENTED]),
        ({"root_cause": "memory"}, [validation.WRONG_AXIS]),
        ({"phase": None}, [validation.MISSING]),
        ({"reasoning": "r" * 500}, []),
        ({"reasoning": "r" * 501}, [validation.LONG_REASONING]),
    ],
)
def test_label_constraints(spark, change, problems):
    df = spark.createDataFrame([tuple({**GOOD, **change}[n] for n in LABELS.names)], LABELS)
    row = validation.check_labels(df).first()
    assert row.problems == problems and row.valid == (not problems)


def test_link_constraints(spark):
    df = spark.createDataFrame(
        [("n", "mast", "x", 0.5, "semantic"), ("n", "nope", "x", 0.5, "semantic"), ("n", "mast", "x", 1.5, "semantic")],
        CROSS_LINKS,
    )
    assert [r.valid for r in validation.check_links(df).collect()] == [True, False, False]


def test_published_conformance_rate(spark):
    """495 of 500 accepted: 4 over-long reasonings and one label of another axis."""
    faults = [{"reasoning": "r" * 501}] * 4 + [{"root_cause": "memory"}] + [{}] * 495
    data = [tuple({**GOOD, **f}[n] for n in LABELS.names) for f in faults]
    df = spark.createDataFrame(data, LABELS).withColumn("classifier_model", F.lit("m"))
    report = {r.kind: r for r in validation.conformance(validation.check_labels(df)).collect()}
    assert report[validation.LONG_REASONING].n_problem == 4
    assert report[validation.WRONG_AXIS].n_problem == 1
    assert report[validation.WRONG_AXIS].rejection_rate == 0.01


def test_parse_responses(spark):
    good = json.dumps({k: v for k, v in GOOD.items() if k not in ("node_id", "needs_review")})
    df = spark.createDataFrame([("a", good), ("b", "{oops")], "node_id string, response string")
    parsed = {r.node_id: r for r in validation.parse_responses(df).collect()}
    assert parsed["a"].locus == "agent" and parsed["a"].needs_review is False
    assert parsed["b"].locus is None


def flaky(fail_first: int):
    def factory():
        seen = {}

        def label(prompt):
            seen[prompt] = seen.get(prompt, 0) + 1
            if seen[prompt] <= fail_first:
                raise labelling.TransientError("try again")
            if prompt == "bad":
                raise ValueError("no")
            return {**{k: v for k, v in GOOD.items() if k != "node_id"}, "prompt_tokens": 5}

        return label

    return factory


def test_labelling_retries_and_isolates_rows(spark):
    prompts = spark.createDataFrame([("a", "good"), ("b", "bad")], "node_id string, prompt string")
    labelled = labelling.label_prompts(prompts, flaky(2), tries=3, wait=0.0)
    assert [r.node_id for r in labelling.accepted(labelled).collect()] == ["a"]
    assert labelling.usage(labelled).first().prompt_tokens == 5
    bad = labelling.rejected(labelled).collect()
    assert [(r.node_id, r.error) for r in bad] == [("b", "ValueError: no")]
    gave_up = labelling.label_prompts(prompts, flaky(3), tries=3, wait=0.0)
    assert labelling.accepted(gave_up).count() == 0
    assert gave_up.filter("error LIKE 'transient%'").count() == 2


def test_axes_are_four():
    assert AXES == ("locus", "phase", "symptom", "root_cause")


def test_the_digest_of_a_prompt_covers_its_prefix(spark, tmp_path):
    docs = [(0, "T\nbody", "crewai", "en", 6), (1, "U", "agno", "de", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    events = spark.sql("SELECT id AS event_id, timestamp '2026-01-02' AS ts, 'click' AS event_type FROM range(2)")
    events.write.parquet(f"{tmp_path}/events.parquet")
    prompts = {r.node_id: dims.system_prompt() + r.prompt for r in QUERIES["render_prompt"].run(spark, str(tmp_path)).collect()}
    found = QUERIES["prompt_with_taxonomy"].run(spark, str(tmp_path)).collect()
    assert len(found) == 2
    for r in found:
        assert r.n_chars == len(prompts[r.node_id])
        assert r.prompt_digest == hashlib.md5(prompts[r.node_id].encode()).hexdigest()


def test_tasks_of_a_labeller_stay_small(spark, monkeypatch):
    """More rows make more tasks, not longer ones; ``parallelism`` is the least."""
    monkeypatch.setattr(labelling, "TASK_ROWS", 100)
    prompts = spark.range(0, 1500, 1, 2).select(F.col("id").cast("string").alias("node_id"), F.lit("p").alias("prompt"))

    whole = labelling.label_prompts(prompts, lambda: lambda p: {}, parallelism=2)
    counts = [r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 1500 and len(counts) == 15 and max(counts) <= 120
    few = labelling.label_prompts(prompts.limit(50), lambda: lambda p: {}, parallelism=2)
    assert few.select(F.spark_partition_id()).distinct().count() == 2


def test_a_wave_reads_its_own_rows(spark, tmp_path):
    """Not all rows once per wave."""
    prompts = spark.range(300).select(F.col("id").cast("string").alias("node_id"), F.concat(F.lit("p"), "id").alias("prompt"))
    asked = prompts.select(labelling.prompt_digest().alias("digest"), "prompt", F.col("node_id").alias("first_id"))
    waves = labelling._waves(asked, 7)
    files = [f for wave in waves for f in wave.inputFiles()]
    assert len(waves) == 7 and len(files) == len(set(files)) >= 7
    assert sorted(r for wave in waves for r in wave.collect()) == sorted(asked.collect())

    def factory():
        def label(prompt):
            if prompt.endswith("7"):
                raise ValueError("no")
            return {"reasoning": prompt}

        return label

    got = labelling.label_resumed(prompts, factory, f"{tmp_path}/store", "m", per_wave=50).collect()
    assert {r.node_id: (r.reasoning, r.error) for r in got} == {
        str(i): (None, "ValueError: no") if i % 10 == 7 else (f"p{i}", None) for i in range(300)
    }
    assert labelling.read_answers(spark, f"{tmp_path}/store", "m").count() == 270
