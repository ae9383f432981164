import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faultloom import dims
from faultloom.operators import curation, merging, stats
from faultloom.plans.evaluation import compare, relabel
from faultloom.plans.weekly import Labelling, WeeklyRun, merge_shards, read_quarantine, run_weekly
from faultloom.schemas import CROSS_LINKS, CURSORS, ISSUES, conform, empty
from faultloom.sources import fs, snapshots, state


def issues(spark, rows):
    """Rows of (node_id, framework, symptom, classified_at or None)."""
    data = [(n, f, s, datetime.fromisoformat(t) if t else None) for n, f, s, t in rows]
    df = spark.createDataFrame(
        data, "node_id string, framework_slug string, symptom string, classified_at timestamp"
    )
    constants = {
        "issue_number": F.lit(1), "title": F.lit("t"), "body": F.lit("b"), "url": F.lit("u"),
        "labels": F.array(F.lit("bug")), "state": F.lit("open"), "is_pull_request": F.lit(False),
        "created_at": F.col("classified_at"), "updated_at": F.col("classified_at"),
        "comment_count": F.lit(0), "locus": F.lit("agent"), "phase": F.lit("action"),
        "root_cause": F.lit("api_misuse"), "confidence": F.lit(0.9), "reasoning": F.lit("r"),
        "needs_review": F.lit(False), "classifier_tier": F.lit("dry_run"),
        "classifier_model": F.lit("m"), "classifier_version": F.lit("v"),
    }
    return conform(df.withColumns(constants), ISSUES)


def found(df):
    return {r.node_id: r.symptom for r in df.collect()}


def test_merge_without_existing_rows(spark):
    new = issues(spark, [("n1", "a", "crash", "2026-05-01"), ("n2", "a", "loop", None)])
    none = empty(spark, ISSUES)
    assert found(merging.merge_latest(new, None)) == {"n1": "crash", "n2": "loop"}
    assert found(merging.merge_latest(new, none)) == {"n1": "crash", "n2": "loop"}
    twice = new.unionByName(new)
    assert merging.merge_latest(twice, none).count() == 2
    assert merging.merge_latest(twice, none, strict_reference=True).count() == 4
    assert merging.merge_latest(twice, None, strict_reference=True).count() == 4


@pytest.mark.parametrize("unique", [False, True])
def test_merge_keeps_the_newest(spark, unique):
    old = issues(spark, [("n1", "a", "crash", "2026-04-30"), ("n2", "a", "crash", None), ("n3", "a", "crash", "2026-05-20"), ("n4", "a", "crash", "2026-05-01")])
    new = issues(spark, [("n1", "a", "loop", "2026-05-17"), ("n2", "a", "loop", None), ("n3", "a", "loop", "2026-05-17"), ("n5", "a", "loop", None)])
    merged = merging.merge_latest(new, old, existing_unique=unique)
    assert found(merged) == {"n1": "loop", "n2": "loop", "n3": "crash", "n4": "crash", "n5": "loop"}
    assert merged.count() == 5 and merged.columns == ISSUES.names


def test_incremental_merge_adds(spark):
    old = issues(spark, [(f"n{i}", "a", "crash", "2026-05-01") for i in range(100)])
    new = issues(spark, [("new", "a", "loop", "2026-05-08")])
    assert merging.merge_latest(new, old).count() == 101


def test_merge_ranks_before_the_shuffle(spark):
    old = issues(spark, [("n1", "a", "crash", "2026-04-30")])
    plan = merging.merge_latest(old, old)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def shard(spark, root, name, revision, rows, cursors=None):
    snapshots.write_snapshot(issues(spark, rows), empty(spark, CROSS_LINKS), f"{root}/shard-{name}/snapshots", revision)
    if cursors is not None:
        with open(f"{root}/shard-{name}/{state.STATE_FILE}", "w") as f:
            f.write(cursors if isinstance(cursors, str) else json.dumps({"last_scraped_at": cursors}))


def test_shards_are_merged(spark, tmp_path):
    root, out, cursors = (str(tmp_path / n) for n in ("shards", "out", "cursors"))
    shard(spark, root, "langchain", "2026-W17", [("n1", "langchain", "crash", "2026-04-20"), ("n2", "langchain", "loop", None)], {"langchain": "2026-04-20T00:00:00+00:00"})
    shard(spark, root, "crewai", "2026-W17", [("n3", "crewai", "crash", "2026-04-21")], {"crewai": "2026-04-21T00:00:00+00:00"})
    shard(spark, root, "agno", "2026-W17", [("n1", "agno", "crash", "2026-04-21")], "{not json")
    base = spark.createDataFrame(
        [("langchain", datetime(2025, 1, 1)), ("swarm", datetime(2025, 2, 2))], CURSORS
    )
    state.save_cursors(base, cursors)
    snapshot = merge_shards(spark, root, out, cursors)
    assert snapshot.endswith("2026-W17")
    rows = spark.read.parquet(f"{snapshot}/issues.parquet")
    assert rows.count() == 4  # shards are concatenated, not deduplicated
    assert spark.read.parquet(f"{snapshot}/taxonomy.parquet").count() == 28
    assert spark.read.parquet(f"{snapshot}/cross_links.parquet").count() == 0
    after = {r.slug: r.last_scraped_at for r in state.load_cursors(spark, cursors).collect()}
    assert after == {
        "langchain": datetime(2026, 4, 20),
        "crewai": datetime(2026, 4, 21),
        "swarm": datetime(2025, 2, 2),
    }


def test_shards_of_two_revisions_are_an_error(spark, tmp_path):
    shard(spark, str(tmp_path), "a", "2026-W17", [("n1", "a", "crash", None)])
    shard(spark, str(tmp_path), "b", "2026-W18", [("n2", "b", "crash", None)])
    with pytest.raises(ValueError, match="Inconsistent revisions"):
        snapshots.read_shards(spark, str(tmp_path))


def test_no_shards_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="No issues.parquet"):
        snapshots.read_shards(spark, str(tmp_path))


def test_later_cursor_file_wins(spark):
    rows = [("b", "x", datetime(2026, 1, 1)), ("a", "x", datetime(2026, 2, 2)), ("a", "y", datetime(2026, 3, 3))]
    df = spark.createDataFrame(rows, "file_path string, slug string, last_scraped_at timestamp")
    merged = {r.slug: r.last_scraped_at for r in state.merge_cursors(df).collect()}
    assert merged == {"x": datetime(2026, 1, 1), "y": datetime(2026, 3, 3)}


def test_publish_accumulates(spark, tmp_path):
    root, corpus = str(tmp_path / "snap"), str(tmp_path / "corpus")
    weeks = {
        "2026-W17": [("n1", "a", "crash", "2026-04-30"), ("n2", "a", "crash", "2026-04-30")],
        "2026-W18": [("n1", "a", "loop", "2026-05-07")],
    }
    for revision, rows in weeks.items():
        snapshot = snapshots.write_snapshot(issues(spark, rows), empty(spark, CROSS_LINKS), root, revision)
        written = snapshots.publish(spark, snapshot, corpus, revision)
        assert set(written) == set(snapshots.TABLES)
    table = lambda rev: snapshots.read_table(spark, snapshots.corpus_table(corpus, rev, "issues"), "issues")
    assert found(table(None)) == {"n1": "loop", "n2": "crash"}
    assert found(table("2026-W18")) == {"n1": "loop", "n2": "crash"}
    assert found(table("2026-W17")) == {"n1": "crash", "n2": "crash"}
    links = snapshots.read_table(spark, snapshots.corpus_table(corpus, None, "cross_links"), "cross_links")
    assert links.count() == 0 and links.columns == CROSS_LINKS.names


def test_publish_switches(spark, tmp_path):
    root, corpus = str(tmp_path / "snap"), str(tmp_path / "corpus")
    one = snapshots.write_snapshot(issues(spark, [("n1", "a", "crash", None)]), empty(spark, CROSS_LINKS), root, "r1")
    snapshots.publish(spark, one, corpus, "r1", also_main=False)
    assert not fs.exists(spark, f"{corpus}/main")
    snapshots.publish(spark, one, corpus, "r1")
    # A snapshot with issues only, replacing instead of adding.
    issues(spark, [("n9", "a", "loop", None)]).write.parquet(f"{root}/r2/issues.parquet")
    written = snapshots.publish(spark, f"{root}/r2", corpus, "r2", cumulative=False)
    assert set(written) == {"issues"}
    main = snapshots.corpus_table(corpus, None, "issues")
    assert found(snapshots.read_table(spark, main, "issues")) == {"n9": "loop"}
    assert snapshots.read_table(spark, f"{corpus}/main/nothing", "issues").count() == 0


def test_a_swap_cut_short_is_undone(spark, tmp_path):
    target = str(tmp_path / "t")
    issues(spark, [("n1", "a", "crash", None)]).write.parquet(f"{target}.previous")
    assert found(snapshots.read_table(spark, target, "issues")) == {"n1": "crash"}
    assert not fs.exists(spark, target)  # readers read the copy; only writers repair
    fs.recover(spark, target)
    assert fs.exists(spark, target) and not fs.exists(spark, f"{target}.previous")


def test_revisions(spark, tmp_path):
    root = str(tmp_path)
    for revision, rows in (("2026-W09", [("n1", "a", "crash", "2026-03-01")]), ("2026-W10", [("n1", "a", "crash", "2026-03-01"), ("n2", "a", "loop", "2026-03-05")])):
        snapshots.write_snapshot(issues(spark, rows), empty(spark, CROSS_LINKS), root, revision)
    (tmp_path / "2026-W11").mkdir()
    assert snapshots.revisions(spark, root) == ["2026-W09", "2026-W10"]
    rows = snapshots.read_revisions(spark, root)
    assert {r.node_id for r in curation.latest_revision(rows).collect()} == {"n1", "n2"}
    assert {r.node_id for r in snapshots.read_latest(spark, root).collect()} == {"n1", "n2"}
    assert snapshots.read_latest(spark, f"{root}/none").count() == 0
    row = stats.growth(rows, F.lit("2026-03-02").cast("timestamp")).first()
    assert (row.total_rows_across_revisions, row.classified_since, row.distinct_issues) == (3, 1, 2)
    old, new = (rows.filter(F.col("revision") == r) for r in ("2026-W09", "2026-W10"))
    labels = dims.taxonomy(spark)
    diff = {(r.what, r.change): r.n for r in curation.revision_diff(old, new, labels, labels).collect()}
    assert diff["issues", "added"] == 1 and sum(diff.values()) == 1


def test_candidates(spark):
    proposed = spark.createDataFrame([("swarm",), ("newbie",)], "slug string")
    known = dims.frameworks(spark)
    assert [r.slug for r in curation.new_candidates(proposed, known).collect()] == ["newbie"]
    assert [r.slug for r in curation.already_listed(proposed, known).collect()] == ["swarm"]


def test_medians_are_exact(spark):
    values = {"even": [0.1, 0.2, 0.4, 0.9], "odd": [0.5] * 5 + [0.7, 1.0], "one": [0.3], "ends": [0.0, 1.0]}
    rows = [(g, v, False) for g, vs in values.items() for v in vs] + [("odd", None, True), ("none", None, True)]
    df = spark.createDataFrame(rows, "framework_slug string, confidence double, needs_review boolean")
    got = {r.framework_slug: r for r in stats.confidence_profile(df).collect()}
    assert {g: round(got[g].median_confidence, 9) for g in values} == {"even": 0.3, "odd": 0.5, "one": 0.3, "ends": 0.5}
    assert got["none"].median_confidence is None and got["none"].mean_confidence == 0.0
    assert got["odd"].n_issues == 8


def test_empty_sample_audit(spark):
    assert stats.drift_audit(empty(spark, ISSUES), 50).count() == 0


def test_rollup_total(spark):
    rows = [(f"n{i}", "a" if i < 7 else "b", "crash", None) for i in range(10)]
    counts = {r.framework_slug: r.n_issues for r in stats.framework_counts(issues(spark, rows)).collect()}
    assert counts == {"a": 7, "b": 3, "Total": 10}


# --- whole runs ------------------------------------------------------------------


def land(path, slug_repo, **over):
    record = {
        "number": 1, "node_id": f"I_{slug_repo}", "title": "crash on start", "body": "trace",
        "html_url": f"https://github.com/{slug_repo}/issues/1", "labels": [], "state": "open",
        "created_at": "2026-04-20T00:00:00Z", "updated_at": "2026-04-21T00:00:00Z", "comments": 0,
    } | over
    path.mkdir(exist_ok=True)
    with open(path / "p.json", "a") as f:
        f.write(json.dumps(record) + "\n")


def weekly(tmp_path, **over):
    names = ("landing", "snapshots", "cursors", "corpus", "quarantine")
    paths = {n: str(tmp_path / n) for n in names}
    return WeeklyRun(**{**paths, "as_of": "2026-04-24T12:00:00Z", **over})


def test_dry_run_of_every_framework(spark, tmp_path):
    for row in dims.FRAMEWORK_ROWS:
        land(tmp_path / "landing", row[1])
    snapshot = run_weekly(spark, weekly(tmp_path))
    assert snapshot.endswith("2026-W17")
    rows = spark.read.parquet(f"{snapshot}/issues.parquet")
    assert rows.groupBy("framework_slug").count().filter("count = 1").count() == 12
    assert [r[0] for r in rows.select("classifier_tier").distinct().collect()] == ["dry_run"]
    for name in snapshots.TABLES:
        assert fs.exists(spark, f"{snapshot}/{name}.parquet")
    cursors = state.load_cursors(spark, str(tmp_path / "cursors")).collect()
    assert len(cursors) == 12 and {r.last_scraped_at for r in cursors} == {datetime(2026, 4, 21)}
    # A second run sees only what is at or after the cursors, and adds it to main.
    land(tmp_path / "landing", "openai/swarm", node_id="late", updated_at="2026-04-28T00:00:00Z")
    land(tmp_path / "landing", "openai/swarm", node_id="early", updated_at="2026-04-01T00:00:00Z")
    snapshot = run_weekly(
        spark, weekly(tmp_path, as_of="2026-04-30T12:00:00Z", main_is_unique=True)
    )
    ids = {r.node_id for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()}
    assert "late" in ids and "early" not in ids
    main = snapshots.read_table(spark, f"{tmp_path}/corpus/main/issues", "issues")
    assert main.count() == 13


def test_several_versions_of_an_issue_count_once(spark, tmp_path):
    for day, title in ((21, "crash one"), (23, "crash three"), (22, "crash two")):
        land(tmp_path / "landing", "openai/swarm", title=title, updated_at=f"2026-04-{day}T00:00:00Z")
    snapshot = run_weekly(spark, weekly(tmp_path))
    assert [r.title for r in spark.read.parquet(f"{snapshot}/issues.parquet").collect()] == ["crash three"]


def test_empty_week(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "p.json").write_text("")
    snapshot = run_weekly(spark, weekly(tmp_path))
    for name in ("issues", "cross_links"):
        table = spark.read.parquet(f"{snapshot}/{name}.parquet")
        assert table.count() == 0 and table.columns == snapshots.TABLES[name].names


def test_only_framework_with_labeller_and_links(spark, tmp_path):
    land(tmp_path / "landing", "microsoft/autogen", title="websurfer crash after tool", node_id="a")
    land(tmp_path / "landing", "microsoft/autogen", title="crash unlabelled", node_id="b", body="refuse")
    land(tmp_path / "landing", "openai/swarm")
    land(tmp_path / "landing", "microsoft/autogen", state="odd", node_id="c")

    def factory():
        def label(prompt):
            if "refuse" in prompt:
                raise ValueError("refused")
            return {"locus": "agent", "phase": "action", "symptom": "crash", "root_cause": "api_misuse", "confidence": 0.9, "reasoning": "r"}

        return label

    def records(session):
        return session.createDataFrame([("mast", "1", "t", "websurfer crash after tool"), ("mast", "2", "t", "bakery revenue"), ("mast", "3", "t", "alpine towns")], "corpus_id string, external_id string, title string, text string")

    run = weekly(tmp_path, only_framework="autogen", usage=str(tmp_path / "usage"), labelling=Labelling(factory, "v4_pro", "m1"), loaders={"mast": records})
    snapshot = run_weekly(spark, run)
    rows = spark.read.parquet(f"{snapshot}/issues.parquet").collect()
    assert [(r.node_id, r.classifier_model, r.symptom) for r in rows] == [("a", "m1", "crash")]
    links = spark.read.parquet(f"{snapshot}/cross_links.parquet").collect()
    assert [(r.node_id, r.external_id, r.method) for r in links] == [("a", "1", "semantic")]
    assert [r.node_id for r in spark.read.parquet(f"{tmp_path}/usage/*/*").collect()] == ["a"]
    quarantine = f"{tmp_path}/quarantine"
    bad = read_quarantine(spark, quarantine, "payloads").collect()
    assert [(r.problem, r.revision, r.run_id) for r in bad] == [("unknown state", "2026-W17", "2026-04-24T120000Z-autogen")]
    assert [r.node_id for r in read_quarantine(spark, quarantine, "labels").collect()] == ["b"]
    # A second run in the week keeps what the first one put aside.
    run_weekly(spark, weekly(tmp_path, as_of="2026-04-24T18:00:00Z"))
    assert read_quarantine(spark, quarantine, "payloads").count() == 2
    with pytest.raises(ValueError, match="Unknown framework slug"):
        run_weekly(spark, weekly(tmp_path, only_framework="nope"))


def test_rows_over_the_cap_wait(spark, tmp_path):
    for day in range(1, 8):
        for repo in ("microsoft/autogen", "openai/swarm"):
            land(tmp_path / "landing", repo, node_id=f"{repo[0]}{day}", updated_at=f"2026-04-0{day}T00:00:00Z")
    with pytest.raises(ValueError, match="backlog"):
        weekly(tmp_path, cap=3)
    backlog = str(tmp_path / "backlog")
    seen = []
    for week in range(1, 5):
        run = weekly(tmp_path, cap=3, backlog=backlog, corpus=None, as_of=f"2026-05-{7 * week:02d}T00:00:00Z")
        rows = spark.read.parquet(f"{run_weekly(spark, run)}/issues.parquet")
        seen.append(sorted(r.node_id for r in rows.collect()))
        if week == 1:
            land(tmp_path / "landing", "openai/swarm", node_id="o9", updated_at="2026-04-09T00:00:00Z")
    assert seen[0] == ["m5", "m6", "m7", "o5", "o6", "o7"]
    assert {n for ns in seen for n in ns} == {f"{r}{d}" for r in "mo" for d in range(1, 8)} | {"o9"}


def test_versions_may_stop_anywhere(spark, tmp_path):
    path = str(tmp_path / "t")
    assert fs.current_version(spark, path) is None
    for n in range(4):
        fs.write_version(spark.range(n + 1), path)
        junk = f"{path}/v-{n + 2}-stopped"
        spark.range(99).write.parquet(junk)
        fs.delete(spark, f"{junk}/_SUCCESS")
        assert spark.read.parquet(fs.current_version(spark, path)).count() == n + 1
    assert len([n for n in fs.subdirs(spark, path) if not n.endswith("stopped")]) == 2


def test_relabel_and_compare(spark, tmp_path):
    rows = [(f"n{i}", "a" if i < 30 else "b", "crash" if i % 2 else "loop", "2026-05-01") for i in range(40)]
    table = issues(spark, rows)

    def factory():
        return lambda prompt: {"locus": "agent", "phase": "action", "symptom": "crash", "root_cause": "api_misuse", "confidence": 0.5, "reasoning": "r", "needs_review": True}

    again = relabel(table, factory, "second", sample_size=20)
    assert again.count() == 20 and again.filter("classifier_model = 'second'").count() == 20
    assert {r[0]: r[1] for r in again.groupBy("framework_slug").count().collect()} == {"a": 15, "b": 5}
    table.write.parquet(str(tmp_path / "a"))
    again.write.parquet(str(tmp_path / "b"))
    report = compare(spark, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "report"))
    assert report["n"] == 20 and report["per_axis"]["locus"]["kappa"] is None
    assert report["per_axis"]["symptom"]["kappa"] == 0.0 and report["mean_kappa"] is None
    assert spark.read.text(str(tmp_path / "report")).count() == 4


def test_shards_are_found_at_any_depth(spark, tmp_path):
    deep = "/".join("abcdefghij")
    for folder in ("x", deep):
        issues(spark, [(folder, "a", "crash", None)]).write.parquet(str(tmp_path / folder / "2026-W17" / "issues.parquet"))
    assert sorted(r.node_id for r in snapshots.read_shards(spark, str(tmp_path)).collect()) == sorted(["x", deep])
    assert fs.find(spark, str(tmp_path / "none"), "issues.parquet") == []


@pytest.mark.parametrize("loud_rows", [3, 10_000])
def test_dealt_merge_shuffles_rows_once(spark, monkeypatch, loud_rows):
    old = issues(spark, [("n1", "a", f"s{i}", "2026-04-30") for i in range(20)] + [(None, "a", "crash", "2026-05-20")] * 6 + [("n4", "a", "crash", None)])
    new = issues(spark, [("n1", "a", "loop", "2026-05-17"), ("n4", "a", "loop", None), ("n5", "a", "loop", None), (None, "a", "loop", "2026-05-17")])
    monkeypatch.setattr(merging, "LOUD_ROWS", loud_rows)
    dealt = merging.merge_dealt(new, old, "bucket", snapshots.bucket_of(8))
    assert found(dealt) == found(merging.merge_latest(new, old)) == {None: "crash", "n1": "loop", "n4": "loop", "n5": "loop"}
    assert dealt.count() == 4 and dealt.columns == [*ISSUES.names, "bucket"]
    if loud_rows > 100:
        planned = merging.merge_dealt(new, old, "bucket", snapshots.bucket_of(8))
        assert planned._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
