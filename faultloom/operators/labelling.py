"""The labelling job: prompts in, typed labels out, through a hook the caller supplies."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.operators.validation import check_labels
from faultloom.schemas import LABELS, USAGE, empty
from faultloom.session import materialize, scratch_path
from faultloom.sources import fs

# A labeller takes a prompt and returns the label fields, optionally with token counts.
Labeller = Callable[[str], Mapping[str, Any]]
LabellerFactory = Callable[[], Labeller]


class TransientError(Exception):
    """A failure worth another try: a dropped connection, a timeout, a rate limit."""


_FIELDS = [f.name for f in LABELS if f.name != "node_id"]
_COUNTS = [f.name for f in USAGE if f.name != "node_id"]
#: Rows of a task are at most about this many, so that tasks stay small as the input grows.
TASK_ROWS = 10_000

LABELLED = T.StructType(
    [*LABELS.fields, *USAGE.fields[1:], T.StructField("error", T.StringType())]
)
_ARROW = {
    T.StringType(): pa.string(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.LongType(): pa.int64(),
}


_KINDS = {f.name: f.dataType for f in LABELLED if f.name in {*_FIELDS, *_COUNTS}}


def _typed(name: str, value: Any) -> Any:
    """A field of an answer as its column takes it; a TypeError for what it does not."""
    kind = _KINDS[name]
    if value is None:
        return False if name == "needs_review" else None
    if kind == T.BooleanType() and isinstance(value, bool):
        return value
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == T.StringType() and isinstance(value, str):
        value.encode()  # lone surrogates are no text
        return value
    if kind == T.DoubleType() and number:
        return float(value)
    if kind == T.LongType() and number and value == int(value) and abs(value) < 1 << 63:
        return int(value)
    raise TypeError(f"{name}: {type(value).__name__} instead of {kind.simpleString()}")


def _attempt(labeller: Labeller, prompt: str, tries: int, wait: float) -> dict[str, Any]:
    for left in range(tries - 1, -1, -1):
        try:
            answer = labeller(prompt)
            return {n: _typed(n, answer.get(n)) for n in _KINDS} | {"error": None}
        except TransientError as error:
            if not left:
                return {"error": f"transient: {error}"}
            time.sleep(wait)
            wait *= 2
        except Exception as error:  # a row that cannot be labelled must not end the job
            return {"error": f"{type(error).__name__}: {error}"}
    raise AssertionError("tries must be at least 1")


def label_prompts(
    prompts: DataFrame,
    factory: LabellerFactory,
    *,
    tries: int = 3,
    wait: float = 1.0,
    parallelism: int | None = None,
    at_once: int = 100,
    concurrent: int = 1,
    rows: int | None = None,
) -> DataFrame:
    """Run a labeller over (node_id, prompt) rows.

    The factory runs once per task, so a client and its connection are shared
    by the rows of a partition. With ``concurrent`` calls a task has that many
    threads, each with a labeller of its own; calls in flight never exceed
    ``concurrent`` times the tasks that run. A row that fails, or whose answer has a field of
    the wrong type, keeps its error and no labels. A column ``row``, where there
    is one, is passed through beside the labels, so that nothing need be joined
    back. ``parallelism`` spreads the calls evenly over that many tasks, or over more
    where a task would have above ``TASK_ROWS`` rows, which are counted if ``rows``
    does not say how many there are; rows go on after ``at_once`` answers. Write the result before using it twice: every
    use of the frame calls the labeller.
    """
    passed = [f for f in prompts.schema if f.name == "row"]
    prompts = prompts.select("node_id", "prompt", *[f.name for f in passed])
    if parallelism:
        rows = prompts.count() if rows is None else rows
        prompts = prompts.repartition(max(parallelism, -(-rows // TASK_ROWS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = threading.local()

        def answer(text: str) -> dict[str, Any]:
            if not hasattr(own, "labeller"):
                own.labeller = factory()
            return _attempt(own.labeller, text, tries, wait)

        with ThreadPoolExecutor(concurrent) as pool:
            for batch in batches:
                for lo in range(0, batch.num_rows, at_once):
                    part = batch.slice(lo, at_once)
                    ids, texts = (part.column(name).to_pylist() for name in ("node_id", "prompt"))
                    answers = pool.map(answer, texts) if concurrent > 1 else map(answer, texts)
                    rows = [{"node_id": i, **a} for i, a in zip(ids, answers, strict=True)]
                    out = pa.RecordBatch.from_pylist(rows, schema)
                    for f in passed:
                        out = out.append_column(f.name, part.column(f.name))
                    yield out

    schema = pa.schema([(field.name, _ARROW[field.dataType]) for field in LABELLED])
    return prompts.mapInArrow(run, T.StructType([*LABELLED.fields, *passed]))


_TRIED = T.StructType([T.StructField("digest", T.StringType()), *LABELLED.fields[1:]])
ANSWERS = T.StructType(_TRIED.fields[:-1])


def prompt_digest(prompt: str = "prompt") -> Column:
    return F.sha2(F.col(prompt), 256)


def _answers_of(store: str, model: str) -> str:
    """A folder for each model, named so that any model name is a folder."""
    return f"{store.rstrip('/')}/model={model.encode().hex()}"


def read_answers(spark: SparkSession, store: str, model: str) -> DataFrame:
    """What a model has answered so far, by the digest of the prompt: the waves that were written completely."""
    folder = _answers_of(store, model)
    waves = [f"{folder}/{n}" for n in fs.subdirs(spark, folder) if fs.exists(spark, f"{folder}/{n}/_SUCCESS")]
    return spark.read.schema(ANSWERS).parquet(*waves) if waves else empty(spark, ANSWERS)


def _waves(asked: DataFrame, n: int) -> list[DataFrame]:
    """The rows in n parts of about one size, each of which reads files of its own."""
    if n < 2:
        return [asked] * n
    spark, path = asked.sparkSession, scratch_path(asked.sparkSession, "waves")
    dealt = asked.withColumn("wave", F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int"))
    dealt.repartition("wave").write.partitionBy("wave").parquet(path)
    return [spark.read.schema(asked.schema).parquet(f"{path}/{name}") for name in fs.subdirs(spark, path)]


def label_resumed(
    prompts: DataFrame,
    factory: LabellerFactory,
    store: str,
    model: str,
    *,
    per_wave: int = 10_000,
    **how: Any,
) -> DataFrame:
    """``label_prompts`` that asks for nothing that the store has an answer to.

    Prompts are known by their digest, so equal prompts are asked once. Those
    without an answer are asked in waves of about ``per_wave``, each of which is
    written to the store before the next begins: a job that stops repeats one wave
    at most. Errors are not stored, so the next job asks those prompts again; this
    one returns them. ``how`` goes to ``label_prompts``. Token counts are given for
    the first row of a prompt that this call asked; other rows have none.
    """
    spark = prompts.sparkSession
    keyed = prompts.withColumn("digest", prompt_digest())
    known = read_answers(spark, store, model).select("digest")
    asked = keyed.groupBy("digest").agg(F.min("prompt").alias("prompt"), F.min("node_id").alias("first_id"))
    asked = materialize(asked.join(known, "digest", "left_anti"), "unanswered")
    tried = []
    for own in _waves(asked, -(-asked.count() // per_wave)):
        calls = label_prompts(own.select(F.col("digest").alias("node_id"), "prompt"), factory, rows=per_wave, **how)
        tried.append(scratch_path(spark, "wave"))
        calls.withColumnRenamed("node_id", "digest").write.parquet(tried[-1])
        calls = spark.read.schema(_TRIED).parquet(tried[-1])
        folder = f"{_answers_of(store, model)}/wave-{uuid.uuid4().hex}"
        calls.filter("error IS NULL").drop("error").write.parquet(folder)
    calls = spark.read.schema(_TRIED).parquet(*tried) if tried else empty(spark, _TRIED)
    failed = calls.filter("error IS NOT NULL").select("digest", "error")
    found = read_answers(spark, store, model).dropDuplicates(["digest"])
    joined = keyed.join(found, "digest", "left").join(failed, "digest", "left")
    joined = joined.join(asked.select("digest", "first_id"), "digest", "left")
    paid = F.col("node_id").eqNullSafe(F.col("first_id"))
    counts = {c: F.when(paid, F.col(c)) for c in _COUNTS}
    passed = ["row"] if "row" in prompts.columns else []
    return joined.withColumns(counts).select(*LABELLED.names, *passed)


def accepted(labelled: DataFrame) -> DataFrame:
    """Labels that were produced and satisfy every constraint."""
    return accepted_rows(labelled).select(*LABELS.names)


def accepted_rows(labelled: DataFrame) -> DataFrame:
    """The same with all columns, what was passed through among them."""
    return check_labels(labelled.filter("error IS NULL")).filter("valid")


def rejected(labelled: DataFrame) -> DataFrame:
    """The others, with the error or the broken constraints."""
    return check_labels(labelled).filter("error IS NOT NULL OR NOT valid")


def usage(labelled: DataFrame) -> DataFrame:
    """Token counts per call, for the roll-up."""
    return labelled.filter("error IS NULL").select(*USAGE.names)


def stored_responses(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """The labeller that asks nobody: answers joined from a table of responses."""
    return prompts.select("node_id").join(responses, "node_id")
