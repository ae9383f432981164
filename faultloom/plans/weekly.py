"""The weekly run: read what is new, label it, link it, publish it, move the cursors."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultloom import __version__
from faultloom.functions.time import revision_tag
from faultloom.operators import intake, labelling, linking, merging, rows
from faultloom.schemas import CROSS_LINKS, PAYLOAD, RAW_ISSUE, empty
from faultloom.session import materialize, pin_utc
from faultloom.sources import dead_letters, fs, inbox, payloads, snapshots, state
from faultloom.sources.records import Loader, load_records


@dataclass(frozen=True)
class Labelling:
    """How issues get their labels; without a factory they get placeholders.

    With a store for ``answers``, no prompt that a model has answered is asked again,
    also if a run stops half way.
    """

    factory: labelling.LabellerFactory | None = None
    tier: str = "v4_pro"
    model: str = "unnamed"
    tries: int = 3
    parallelism: int | None = None
    concurrent: int = 1
    answers: str | None = None
    per_wave: int = 10_000


@dataclass(frozen=True)
class WeeklyRun:
    """Where a run reads and writes. ``as_of`` is its clock, an ISO instant.

    ``main_is_unique`` says that only runs like this one ever published to the
    corpus, so its main table has a row per issue. With a ``cap``, rows over it
    wait in the ``backlog`` table; in the next run they come before anything new.
    With an ``inbox``, files that landed are read once, by a stream that fills it;
    without one, all of the landing folder is read. An inbox is for one job: runs of
    single frameworks have one each. ``dead_letters`` keeps issues that could not be
    labelled and, of a run with an inbox, payloads that could not be typed (a run
    without one reads those again anyway); each run tries those again that have had
    fewer than ``max_attempts``.
    A run of a shard names a ``state_folder`` in the shard tree, where its cursors
    are written as the file that ``merge_shards`` reads.
    """

    landing: str
    snapshots: str
    cursors: str
    as_of: str
    quarantine: str
    corpus: str | None = None
    main_is_unique: bool = False
    usage: str | None = None
    only_framework: str | None = None
    cap: int | None = None
    backlog: str | None = None
    inbox: str | None = None
    dead_letters: str | None = None
    max_attempts: int = 3
    state_folder: str | None = None
    labelling: Labelling = field(default_factory=Labelling)
    loaders: Mapping[str, Loader] = field(default_factory=dict)
    link_options: Mapping[str, object] = field(default_factory=dict)


    def __post_init__(self):
        if self.cap and not self.backlog:
            raise ValueError("a capped run needs a backlog for the rows over the cap")

    @property
    def run_id(self) -> str:
        """Tells runs of one week apart. A run that is repeated has the same."""
        return f"{self.as_of.replace(':', '')}-{self.only_framework or 'all'}"


def read_quarantine(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """What all runs have quarantined of a kind, ``payloads`` or ``labels``, with revision and run."""
    found = spark.read.parquet(f"{path}/*/*/{kind}")
    part = F.split(F.col("_metadata.file_path"), "/")
    return found.select(
        "*", F.element_at(part, -4).alias("revision"), F.element_at(part, -3).alias("run_id")
    )


def run_weekly(spark: SparkSession, run: WeeklyRun) -> str:
    """Run once and return the snapshot's directory.

    Cursors move last, after the snapshot and its publication are complete, so
    a run that dies is repeated in full. Rows that cannot be read or labelled
    go to the quarantine folder with the reason, in a folder of this run's own.
    """
    pin_utc(spark)
    clock = F.lit(run.as_of).cast("timestamp")
    revision = spark.range(1).select(revision_tag(clock)).first()[0]
    cursors = state.load_cursors(spark, run.cursors)

    arrived, upto = _arrived(spark, run)
    typed = payloads.type_payloads(arrived, keep=dead_letters.FATE + ["raw"])
    if run.inbox:
        # Used several times, last when the dead letters it was made of are replaced.
        typed = materialize(typed, "typed")
    bad = payloads.quarantine(typed)
    aside = bad.drop(*dead_letters.FATE, "raw")
    aside.write.mode("overwrite").parquet(f"{run.quarantine}/{revision}/{run.run_id}/payloads")
    # A payload that is tried again was landed before; its framework has moved on since.
    again = F.col("attempts") > 0
    fresh = payloads.good_rows(typed.filter(F.col("attempts").isNull()))
    replayed = payloads.good_rows(typed.filter(again))
    if run.only_framework:
        fresh, replayed = (intake.only_framework(x, run.only_framework) for x in (fresh, replayed))
    wanted = intake.since_cursor(fresh, cursors).unionByName(replayed)
    wanted, kept = take_turn(spark, wanted, run.backlog, run.cap, run.only_framework)
    spent, retried = None, None
    if run.dead_letters and run.labelling.factory:
        kept, spent, retried = _with_dead_issues(spark, kept, run)

    issues, failed = _labelled(kept, run, revision, clock)
    issues = materialize(issues, "issues")
    records = load_records(spark, run.loaders)
    links = linking.link_issues(issues, records, **run.link_options)
    snapshot = snapshots.write_snapshot(issues, links, run.snapshots, revision)
    if run.corpus:
        snapshots.publish(
            spark, snapshot, run.corpus, revision, existing_unique=run.main_is_unique
        )
    if run.backlog:
        leave(spark, wanted, kept, run.backlog, run.only_framework)
    if run.inbox and run.dead_letters:
        left = dead_letters.counted(bad.select("raw.*", payloads.PROBLEM, *dead_letters.FATE), payloads.PROBLEM, run.run_id)
        had = dead_letters.read(spark, run.dead_letters, "payloads").filter(~dead_letters.may_retry(run.max_attempts))
        dead_letters.write(had.unionByName(left.drop(payloads.PROBLEM)), run.dead_letters, "payloads")
    if spent is not None:
        left = dead_letters.counted(failed.join(retried, "node_id", "left"), "error", run.run_id)
        dead_letters.write(spent.unionByName(left.drop("error")), run.dead_letters, "issues")
    state.save_cursors(state.advance(cursors, intake.next_cursors(kept)), run.cursors)
    if run.state_folder:
        state.write_state_file(state.load_cursors(spark, run.cursors), run.state_folder)
    if run.inbox:
        inbox.finish(spark, run.inbox, upto)
    return snapshot


def _arrived(spark: SparkSession, run: WeeklyRun) -> tuple[DataFrame, int]:
    """Payloads of this run as columns and once more as ``raw``, with what is known of earlier attempts."""
    if run.inbox:
        inbox.fill(spark, run.landing, run.inbox)
        found, upto = inbox.waiting(spark, run.inbox)
    else:
        found, upto = payloads.read_landing(spark, run.landing), -1
    fate = {f.name: F.lit(None).cast(f.dataType) for f in dead_letters.KINDS["payloads"] if f.name in dead_letters.FATE}
    arrived = found.withColumns(fate)
    if run.inbox and run.dead_letters:
        dead = dead_letters.read(spark, run.dead_letters, "payloads").filter(dead_letters.may_retry(run.max_attempts))
        arrived = arrived.unionByName(dead)
    raw = F.struct(*PAYLOAD.names) if run.inbox and run.dead_letters else F.lit(None).cast("string")
    return arrived.withColumn("raw", raw), upto


def take_turn(
    spark: SparkSession, new: DataFrame, backlog: str | None, cap: int | None, only_framework: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(wanted, kept): failure reports of the new rows and the backlog, and those a capped run takes.

    Rows of the backlog come first, the newest of them before the others.
    """
    waits = F.lit(False)
    found = fs.current_version(spark, backlog) if backlog else None
    tagged = new.withColumn("waits", waits)
    if found:
        rest = spark.read.schema(new.schema).parquet(found)
        if only_framework:
            rest = intake.only_framework(rest, only_framework)
        tagged = tagged.unionByName(rest.withColumn("waits", F.lit(True)))
    # Of versions of one issue the newest is taken; it waits if any of them has waited.
    wanted = intake.keep_failures(intake.latest_versions(tagged.drop("waits")))
    if found:
        ids = tagged.filter("waits").select("node_id").distinct().withColumn("waits", F.lit(True))
        wanted = wanted.join(ids, "node_id", "left").withColumn("waits", F.coalesce("waits", waits))
    else:
        wanted = wanted.withColumn("waits", waits)
    # The kept rows feed the labels, the links and the cursors; read the landing files once.
    wanted = materialize(wanted, "wanted")
    if not cap:
        return wanted.select(*new.columns), wanted.select(*new.columns)
    kept = materialize(intake.cap_by_cutoff(wanted, cap, F.col("waits")).select(*new.columns), "kept")
    return wanted.select(*new.columns), kept


def leave(spark: SparkSession, wanted: DataFrame, kept: DataFrame, backlog: str, only_framework: str | None = None) -> None:
    """Write the rows that wait for the next run, those of frameworks that this run left alone among them."""
    over = wanted.join(kept.select("node_id"), "node_id", "left_anti").select(*wanted.columns)
    found = fs.current_version(spark, backlog)
    if found and only_framework:
        others = spark.read.schema(wanted.schema).parquet(found)
        over = over.unionByName(others.filter(~F.col("framework_slug").eqNullSafe(only_framework)))
    fs.write_version(over, backlog)


def _with_dead_issues(spark: SparkSession, kept: DataFrame, run: WeeklyRun) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to label, dead letters that stay as they are, attempts of those tried again).

    An issue that has come anew is not replayed beside its newer version.
    """
    dead = dead_letters.read(spark, run.dead_letters, "issues")
    mine = dead_letters.may_retry(run.max_attempts)
    if run.only_framework:
        mine = mine & F.col("framework_slug").eqNullSafe(run.only_framework)
    waiting = dead.filter(mine)
    older = waiting.join(kept.select("node_id"), "node_id", "left_anti").select(*RAW_ISSUE.names)
    rows_ = materialize(kept.unionByName(older), "kept-and-replayed")
    attempts = waiting.select("node_id", "attempts", "first_run", F.lit(None).cast("string").alias("reason"))
    return rows_, dead.filter(~mine), materialize(attempts, "attempts")


def _labelled(kept: DataFrame, run: WeeklyRun, revision: str, clock) -> tuple[DataFrame, DataFrame | None]:
    """Labelled issues, and the issues that failed with the error (None where nothing was asked)."""
    how = run.labelling
    if how.factory is None:
        return rows.dry_run_issues(kept, clock), None
    asked = rows.prompts_with_rows(kept)
    calls = {"tries": how.tries, "parallelism": how.parallelism, "concurrent": how.concurrent}
    if how.answers:
        labelled = labelling.label_resumed(asked, how.factory, how.answers, how.model, per_wave=how.per_wave, **calls)
    else:
        labelled = labelling.label_prompts(asked, how.factory, **calls)
    # Written before use: each use of the frame would call the labeller again.
    labelled = materialize(labelled, "labels")
    failed = labelling.rejected(labelled).select("row.*", F.coalesce("error", F.lit("broken constraint")).alias("error"))
    bad = labelling.rejected(labelled).drop("row")
    bad.write.mode("overwrite").parquet(f"{run.quarantine}/{revision}/{run.run_id}/labels")
    if run.usage:
        calls = labelling.usage(labelled)
        calls.write.mode("overwrite").parquet(f"{run.usage}/{revision}/{run.run_id}")
    stamped = rows.stamped_rows(
        rows.with_labels(labelling.accepted_rows(labelled)),
        tier=how.tier,
        model=how.model,
        version=__version__,
        classified_at=clock,
    )
    return stamped, failed


def merge_shards(
    spark: SparkSession, shards: str, snapshots_root: str, cursors: str | None = None
) -> str:
    """Fold shards of one revision into a snapshot, and their cursor files into the cursors.

    Cross-links depend on the whole batch and stay empty until the next weekly run.
    """
    pin_utc(spark)
    found = snapshots.read_shards(spark, shards)
    revision = snapshots.find_shards(spark, shards)[0].rstrip("/").split("/")[-2]
    merged = merging.union_shards(found)
    snapshot = snapshots.write_snapshot(merged, empty(spark, CROSS_LINKS), snapshots_root, revision)
    if cursors:
        base = state.load_cursors(spark, cursors)
        state.save_cursors(state.merge_cursors(state.read_state_files(spark, shards), base), cursors)
    return snapshot
