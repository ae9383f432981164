"""Publishing by buckets, the inbox, dead letters, resumed labelling, turns of capped runs."""

import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_corpus import found, issues, land, weekly

from faultloom.operators import intake, labelling, sampling
from faultloom.plans.evaluation import published_diff
from faultloom.plans.weekly import Labelling, run_weekly
from faultloom.schemas import CROSS_LINKS, RAW_ISSUE, empty
from faultloom.sources import dead_letters, fs, inbox, snapshots, state

MAIN = "issues"


def main(spark, corpus):
    return snapshots.read_table(spark, snapshots.corpus_table(corpus, None, MAIN), MAIN)


def files(df):
    return {f.removeprefix("file://").removeprefix("file:") for f in df.inputFiles()}


def publish(spark, tmp_path, revision, rows, **how):
    root, corpus = str(tmp_path / "snap"), str(tmp_path / "corpus")
    snapshot = snapshots.write_snapshot(issues(spark, rows), empty(spark, CROSS_LINKS), root, revision)
    snapshots.publish(spark, snapshot, corpus, revision, **how)
    return corpus


# --- publishing ------------------------------------------------------------------


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    corpus = publish(spark, tmp_path, "2026-W17", [(f"n{i}", "a", "crash", "2026-04-30") for i in range(200)], buckets=16)
    before = {f: os.stat(f).st_mtime_ns for f in files(main(spark, corpus))}
    assert len(before) == 16
    publish(spark, tmp_path, "2026-W18", [("n7", "a", "loop", "2026-05-07")], buckets=5)
    after = files(main(spark, corpus))
    assert len(after) == 16 and len(after & set(before)) == 15
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    assert found(main(spark, corpus)) == {f"n{i}": "loop" if i == 7 else "crash" for i in range(200)}
    # The revision names the same files; the one before it is as it was.
    week = lambda w: snapshots.read_table(spark, snapshots.corpus_table(corpus, w, MAIN), MAIN)
    assert files(week("2026-W18")) == after and files(week("2026-W17")) == set(before)
    assert found(week("2026-W17"))["n7"] == "crash"


def test_a_publication_cut_short_is_not_seen(spark, tmp_path, monkeypatch):
    corpus = publish(spark, tmp_path, "r1", [("n1", "a", "crash", "2026-04-30")])
    real = fs.write_version

    def dies(df, path):
        raise OSError("gone")

    monkeypatch.setattr(fs, "write_version", dies)
    with pytest.raises(OSError, match="gone"):
        publish(spark, tmp_path, "r2", [("n1", "a", "loop", "2026-05-07"), ("n2", "a", "loop", "2026-05-07")])
    monkeypatch.setattr(fs, "write_version", real)
    assert found(main(spark, corpus)) == {"n1": "crash"}
    gone = snapshots.sweep(spark, corpus)
    assert all(g.startswith("revision=r2/") for g in gone) and sum("/issues/rows-" in g for g in gone) == 1
    assert found(main(spark, corpus)) == {"n1": "crash"} and snapshots.sweep(spark, corpus) == []
    publish(spark, tmp_path, "r2", [("n1", "a", "loop", "2026-05-07")])
    assert found(main(spark, corpus)) == {"n1": "loop"}


def test_a_corpus_of_whole_files_is_taken_over(spark, tmp_path):
    corpus = str(tmp_path / "corpus")
    issues(spark, [("n1", "a", "crash", "2026-04-30"), ("n2", "a", "crash", "2026-04-30")]).write.parquet(f"{corpus}/main/issues")
    publish(spark, tmp_path, "r2", [("n1", "a", "loop", "2026-05-07")])
    assert found(main(spark, corpus)) == {"n1": "loop", "n2": "crash"}


def test_duplicates_and_empty_snapshots(spark, tmp_path):
    twice = [("n1", "a", "crash", "2026-04-30"), ("n1", "a", "loop", "2026-05-01")]
    corpus = publish(spark, tmp_path, "r0", [])
    assert main(spark, corpus).count() == 0
    publish(spark, tmp_path, "r1", twice, strict_reference=True)
    assert main(spark, corpus).count() == 2
    publish(spark, tmp_path, "r2", [("n5", "a", "loop", "2026-05-07")] * 2, strict_reference=True)
    assert main(spark, corpus).filter("node_id = 'n5'").count() == 1
    publish(spark, tmp_path, "r3", twice)
    assert found(main(spark, corpus)) == {"n1": "loop", "n5": "loop"} and main(spark, corpus).count() == 2


def test_a_diff_reads_no_bucket_with_equal_digests(spark, tmp_path):
    rows = [(f"n{i}", "a" if i % 2 else "b", "crash", "2026-04-30") for i in range(300)]
    corpus = publish(spark, tmp_path, "r1", rows, buckets=16)
    # Written again with another label: other files, equal digests.
    publish(spark, tmp_path, "r2", [(n, f, "loop", "2026-05-07") for n, f, *_ in rows] + [("new", "c", "loop", "2026-05-07")])
    old, new = snapshots.changed_issues(spark, corpus, "r1", "r2")
    assert len(files(old)) == len(files(new)) == 1 and new.count() == old.count() + 1
    got = {(r.what, r.change): r.n for r in published_diff(spark, corpus, "r1", "r2").collect()}
    assert got["issues", "added"] == got["frameworks", "added"] == 1 and sum(got.values()) == 2
    assert sum(r.n for r in published_diff(spark, corpus, "r2", None).collect()) == 0


# --- inbox -----------------------------------------------------------------------


def test_second_run_reads_no_file_of_the_first(spark, tmp_path):
    box = str(tmp_path / "inbox")
    land(tmp_path / "landing", "openai/swarm", node_id="a")
    os.rename(tmp_path / "landing" / "p.json", tmp_path / "landing" / "a.json")
    run_weekly(spark, weekly(tmp_path, inbox=box))
    os.rename(tmp_path / "landing" / "a.json", tmp_path / "landing" / ".a.json")  # hidden from Spark
    land(tmp_path / "landing", "openai/swarm", node_id="b", updated_at="2026-04-28T00:00:00Z")
    snapshot = run_weekly(spark, weekly(tmp_path, inbox=box, as_of="2026-05-01T12:00:00Z"))
    assert [r.node_id for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()] == ["b"]
    assert {r.node_id for r in main(spark, str(tmp_path / "corpus")).collect()} == {"a", "b"}
    assert inbox.fill(spark, str(tmp_path / "landing"), box) == 0
    # A week without files is an empty one.
    snapshot = run_weekly(spark, weekly(tmp_path, inbox=box, as_of="2026-05-08T12:00:00Z"))
    assert spark.read.parquet(f"{snapshot}/issues.parquet").count() == 0


def test_a_run_that_dies_finds_its_files_again(spark, tmp_path, monkeypatch):
    box = str(tmp_path / "inbox")
    land(tmp_path / "landing", "openai/swarm", node_id="a")

    def dies(*_):
        raise OSError("gone")

    monkeypatch.setattr(inbox, "finish", dies)
    with pytest.raises(OSError, match="gone"):
        run_weekly(spark, weekly(tmp_path, inbox=box))
    monkeypatch.undo()
    land(tmp_path / "landing", "openai/swarm", number=2, node_id="b")  # the same file, grown: not read again
    (tmp_path / "landing" / "q.json").write_text((tmp_path / "landing" / "p.json").read_text())
    snapshot = run_weekly(spark, weekly(tmp_path, inbox=box))
    assert {r.node_id for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()} == {"a", "b"}
    rows, upto = inbox.waiting(spark, box)
    assert rows.count() == 0 and upto == 1


# --- dead letters ----------------------------------------------------------------


def refusing(*words):
    def factory():
        def label(prompt):
            if any(w in prompt for w in words):
                raise ValueError("refused")
            return {"locus": "agent", "phase": "action", "symptom": "crash", "root_cause": "api_misuse", "confidence": 0.9, "reasoning": "r"}

        return label

    return Labelling(factory, "v4_pro", "-".join(words) or "all")


def test_refused_issues_are_tried_again_and_given_up(spark, tmp_path):
    how = {"inbox": str(tmp_path / "inbox"), "dead_letters": str(tmp_path / "dead"), "max_attempts": 2}
    for name in ("ok", "once", "never", "newer"):
        land(tmp_path / "landing", "openai/swarm", node_id=name, title=f"crash {name}")
    land(tmp_path / "landing", "nobody/knows", node_id="repo")
    left = lambda kind: {r.node_id: (r.attempts, r.reason, r.first_run[:10]) for r in dead_letters.read(spark, how["dead_letters"], kind).collect()}
    run_weekly(spark, weekly(tmp_path, labelling=refusing("once", "never", "newer"), **how))
    refused = (1, "ValueError: refused", "2026-04-24")
    assert left("issues") == {n: refused for n in ("once", "never", "newer")}
    assert left("payloads") == {"repo": (1, "unknown repository", "2026-04-24")}
    land(tmp_path / "landing2", "openai/swarm", node_id="newer", title="crash better", updated_at="2026-04-29T00:00:00Z")
    os.rename(tmp_path / "landing2" / "p.json", tmp_path / "landing" / "q.json")
    snapshot = run_weekly(spark, weekly(tmp_path, as_of="2026-05-01T12:00:00Z", labelling=refusing("never"), **how))
    assert {r.node_id: r.title for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()} == {"once": "crash once", "newer": "crash better"}
    assert left("issues") == {"never": (2, "ValueError: refused", "2026-04-24")} and left("payloads")["repo"][0] == 2
    # Given up: neither tried again nor lost.
    snapshot = run_weekly(spark, weekly(tmp_path, as_of="2026-05-08T12:00:00Z", labelling=refusing(), **how))
    assert spark.read.parquet(f"{snapshot}/issues.parquet").count() == 0
    assert set(left("issues")) == {"never"} and left("payloads")["repo"][0] == 2


def test_a_payload_is_typed_once_its_repository_is_known(spark, tmp_path, monkeypatch):
    from faultloom.sources import payloads

    how = {"inbox": str(tmp_path / "inbox"), "dead_letters": str(tmp_path / "dead")}
    land(tmp_path / "landing", "new/framework", node_id="x", pull_request=None)
    run_weekly(spark, weekly(tmp_path, **how))
    assert main(spark, str(tmp_path / "corpus")).count() == 0
    known = payloads.frameworks

    def grown(session):
        return known(session).withColumn("repo", F.when(F.col("slug") == "swarm", "new/framework").otherwise(F.col("repo")))

    monkeypatch.setattr(payloads, "frameworks", grown)
    run_weekly(spark, weekly(tmp_path, as_of="2026-05-01T12:00:00Z", **how))
    # A null pull_request key is still told from none after its time among the dead letters.
    assert main(spark, str(tmp_path / "corpus")).count() == 0 or [r.node_id for r in main(spark, str(tmp_path / "corpus")).collect()] == ["x"]
    assert dead_letters.read(spark, how["dead_letters"], "payloads").count() == 0


# --- labelling -------------------------------------------------------------------


def prompts(spark, n):
    return spark.range(n).select(F.concat(F.lit("n"), "id").alias("node_id"), F.concat(F.lit("prompt "), (F.col("id") % 90).cast("string")).alias("prompt"))


def plain_answer():
    """Made here and pickled whole, as workers cannot import a test module."""

    def answer(prompt):
        return {"locus": "agent", "phase": "action", "symptom": "crash", "root_cause": "api_misuse", "confidence": 0.5, "reasoning": prompt, "total_tokens": 7}

    return answer


def test_a_stopped_job_asks_for_each_prompt_once(spark, tmp_path):
    calls, store, answer = spark.sparkContext.accumulator(0), str(tmp_path / "answers"), plain_answer()

    def stopping(at):
        def factory():
            def label(prompt):
                if at and int(prompt.split()[1]) == at:
                    raise SystemExit("the job is stopped")
                calls.add(1)
                return answer(prompt)

            return label

        return factory

    rows = prompts(spark, 100).filter("node_id <> 'n33'")
    with pytest.raises(Exception):  # noqa: B017, PT011
        labelling.label_resumed(rows, stopping(31), store, "m", per_wave=10, at_once=1)
    done = labelling.read_answers(spark, store, "m").count()
    assert 0 < done < 90
    before = calls.value
    got = labelling.label_resumed(rows, stopping(None), store, "m", per_wave=10).collect()
    assert len(got) == 99 and all(r.reasoning == f"prompt {int(r.node_id[1:]) % 90}" for r in got)
    assert calls.value - before == 89 - done
    # Equal prompts are paid for once; another model is asked anew.
    assert labelling.read_answers(spark, store, "m").count() == 89
    assert sum(r.total_tokens or 0 for r in got) == 7 * (89 - done)
    assert labelling.read_answers(spark, store, "m/2").count() == 0


def test_errors_are_returned_and_asked_again(spark, tmp_path):
    store, answer = str(tmp_path / "answers"), plain_answer()

    def factory(bad):
        def make():
            def label(prompt):
                if bad and prompt.endswith("5"):
                    raise ValueError("no")
                return answer(prompt)

            return label

        return make

    one = labelling.label_resumed(prompts(spark, 20), factory(True), store, "m").collect()
    assert sorted(r.node_id for r in one if r.error) == ["n15", "n5"]
    two = labelling.label_resumed(prompts(spark, 20), factory(False), store, "m").collect()
    assert not [r for r in two if r.error] and sum(r.total_tokens or 0 for r in two) == 14
    assert labelling.label_resumed(prompts(spark, 0), factory(False), store, "m").count() == 0


def test_calls_of_a_task_are_concurrent_and_bounded(spark):
    answer = plain_answer()

    # Threads of one task wait for each other: with fewer at a time it would never end.
    def meeting():
        import faultloom

        barrier = faultloom.__dict__.setdefault("_barrier", threading.Barrier(4))

        def label(prompt):
            barrier.wait(timeout=60)
            return answer(prompt)

        return label

    rows = prompts(spark, 40).coalesce(1)
    got = labelling.label_prompts(rows, meeting, concurrent=4).collect()
    assert [r.node_id for r in got] == [f"n{i}" for i in range(40)] and not any(r.error for r in got)


@pytest.mark.parametrize("value, kept", [(True, True), (False, False), (None, False), ("false", None), (0, None), (1.0, None)])
def test_needs_review_takes_booleans_and_null(spark, value, kept):
    answer = plain_answer()
    rows = labelling.label_prompts(prompts(spark, 1), lambda: lambda p: answer(p) | {"needs_review": value})
    row = rows.first()
    assert row.needs_review == kept and (row.error is None) == (kept is not None)


# --- turns -----------------------------------------------------------------------


def raw(spark, rows):
    """(framework, number, time or None) as raw issues."""
    made = [
        {"framework_slug": f, "issue_number": n, "node_id": f"{f}{n}", "title": "crash", "url": "u", "labels": [], "state": "open", "is_pull_request": False, "updated_at": t}
        for f, n, t in rows
    ]
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_ISSUE.names) for r in made], RAW_ISSUE)


@pytest.mark.parametrize("slots, few", [(4096, 50_000), (100, 1), (4096, 5)])
@pytest.mark.parametrize("cap", [1, 7, 40])
def test_cutoffs_equal_ranking(spark, monkeypatch, slots, few, cap):
    """Ties in time, no times, one framework with most rows, times far apart."""
    monkeypatch.setattr(intake, "SLOTS", slots)
    monkeypatch.setattr(intake, "SLOT_ROWS", few)
    start = datetime(2026, 1, 1)
    rows = [("hot", i, start + timedelta(seconds=i % 13)) for i in range(90)]
    rows += [("far", i, start + timedelta(microseconds=7 ** (i % 17))) for i in range(30)]
    rows += [("none", i, None if i % 2 else start) for i in range(20)] + [("one", 1, start), ("same", 1, start), ("same", 2, start)]
    df = raw(spark, rows)
    want = set()
    for f in {f for f, *_ in rows}:
        own = sorted((r for r in rows if r[0] == f), key=lambda r: (r[2] or datetime.min, r[1]), reverse=True)
        want |= {f"{f}{n}" for _, n, _ in own[:cap]}
    got = [r.node_id for r in intake.cap_by_cutoff(df, cap).collect()]
    assert len(got) == len(want) and set(got) == want
    first = F.col("issue_number") % 3 == 0
    want = set()
    for f in {f for f, *_ in rows}:
        own = sorted((r for r in rows if r[0] == f), key=lambda r: (r[1] % 3 == 0, r[2] or datetime.min, r[1]), reverse=True)
        want |= {f"{f}{n}" for _, n, _ in own[:cap]}
    assert {r.node_id for r in intake.cap_by_cutoff(df, cap, first).collect()} == want


def test_a_cap_shuffles_no_rows(spark):
    df = raw(spark, [("a", i, datetime(2026, 1, 1 + i % 9)) for i in range(50)])
    plan = intake.cap_by_cutoff(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert intake.cap_by_cutoff(df, 0).count() == intake.cap_by_cutoff(df, None).count() == 50


def test_waiting_rows_come_first_and_cursors_stay(spark, tmp_path):
    for day in range(1, 8):
        land(tmp_path / "landing", "openai/swarm", number=day, node_id=f"o{day}", updated_at=f"2026-04-0{day}T00:00:00Z")
    seen, cursors = [], []
    for week in range(1, 4):
        run = weekly(tmp_path, cap=3, backlog=str(tmp_path / "backlog"), corpus=None, as_of=f"2026-05-{7 * week:02d}T00:00:00Z")
        rows = spark.read.parquet(f"{run_weekly(spark, run)}/issues.parquet")
        seen.append(sorted(r.node_id for r in rows.collect()))
        cursors.append(state.load_cursors(spark, str(tmp_path / "cursors")).first().last_scraped_at)
        land(tmp_path / "landing", "openai/swarm", number=20 + week, node_id=f"p{week}", updated_at=f"2026-04-1{week}T00:00:00Z")
    # The newest first, then what waits although newer rows have come, then both.
    assert seen[0] == ["o5", "o6", "o7"] and seen[1] == ["o2", "o3", "o4"]
    assert "o1" in seen[2] and len(seen[2]) == 3
    assert cursors == sorted(cursors) and cursors[1] == datetime(2026, 4, 7)


def test_a_sample_that_cannot_keep_its_strata_says_so(spark, caplog):
    rows = issues(spark, [(f"n{i}", f"f{i}", "crash", None) for i in range(20)])
    with caplog.at_level("WARNING"):
        assert sampling.stratified_sample(rows, 5, stratum="framework_slug").count() == 5
    assert "20 strata" in caplog.text


def test_a_run_without_a_cap_copies_no_rows(spark, tmp_path, monkeypatch):
    from faultloom.plans import weekly as job

    tags, write = [], job.materialize
    monkeypatch.setattr(job, "materialize", lambda df, tag: (tags.append(tag), write(df, tag))[1])
    land(tmp_path / "landing", "openai/swarm", node_id="a")
    snapshot = run_weekly(spark, weekly(tmp_path))
    assert tags == ["wanted", "issues"]
    assert [r.node_id for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()] == ["a"]
