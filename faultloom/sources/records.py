"""Outside records that issues are linked to, and the registry of their corpora."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.functions import text as tx
from faultloom.schemas import RECORDS, conform, empty

log = logging.getLogger(__name__)

Loader = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Corpus:
    corpus_id: str
    citation_key: str
    title: str
    url: str


# The outside corpora, in registry order.
CORPORA = (
    Corpus("mast", "cemri2025mast", "MAST: Multi-Agent System Failure Taxonomy", "https://arxiv.org/abs/2503.13657"),
    Corpus("agentfail", "agentfail2025", "AgentFail: Lifecycle of Failures in Platform-Orchestrated Agentic Workflows", "https://arxiv.org/abs/2509.23735"),
    Corpus("agent_error", "agenterror2025", "Where LLM Agents Fail and How They Learn From Failures", "https://arxiv.org/abs/2509.25370"),
    Corpus("faults_agentic", "faultsagentic2026", "Characterizing Faults in Agentic AI", "https://arxiv.org/abs/2603.06847"),
    Corpus("framework_bugs", "frameworkbugs2026", "An Empirical Study of Bugs in Modern LLM Agent Frameworks", "https://arxiv.org/abs/2602.21806"),
)

_FAILURE_MODE = "failure mode"
TRACES = T.StructType(
    [
        T.StructField("round", T.StringType()),
        T.StructField("mas_name", T.StringType()),
        T.StructField("benchmark_name", T.StringType()),
        T.StructField("trace_id", T.StringType()),
        T.StructField("trace", T.StringType()),
        T.StructField(
            "annotations",
            T.ArrayType(T.StructType([T.StructField(_FAILURE_MODE, T.StringType())])),
        ),
    ]
)


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """Trace records from a JSON array file."""
    return spark.read.schema(TRACES).option("multiLine", True).json(path)


def trace_records(traces: DataFrame, corpus_id: str = "mast") -> DataFrame:
    """Traces as records: names, the failure modes' first lines and the trace in one text."""
    name, benchmark = tx.or_empty(F.col("mas_name")), tx.or_empty(F.col("benchmark_name"))
    modes = F.array_join(
        F.transform(
            F.coalesce("annotations", F.array()),
            lambda a: tx.first_line(tx.or_empty(a[_FAILURE_MODE])),
        ),
        " | ",
    )
    return traces.select(
        F.lit(corpus_id).alias("corpus_id"),
        F.concat_ws(
            "-", tx.or_empty(F.col("round")), name, tx.or_empty(F.col("trace_id"))
        ).alias("external_id"),
        F.concat(F.lit("MAST trace: "), name, F.lit(" on "), benchmark).alias("title"),
        tx.strip(F.concat_ws(" ", name, benchmark, modes, tx.or_empty(F.col("trace")))).alias(
            "text"
        ),
    )


def load_records(
    spark: SparkSession,
    loaders: Mapping[str, Loader],
    corpora: Sequence[Corpus] = CORPORA,
) -> DataFrame:
    """Records of every corpus that has a loader; a loader that fails is skipped.

    Planning a read is what fails on a missing path. Rows that hold no valid
    record come out of a permissive read as nulls and carry no text.
    """
    loaded = []
    for corpus in corpora:
        loader = loaders.get(corpus.corpus_id)
        if loader is None:
            continue
        try:
            loaded.append(conform(loader(spark), RECORDS))
        except (PySparkException, OSError, ValueError) as error:
            log.warning("skipping records of %s: %s", corpus.corpus_id, error)
    if not loaded:
        return empty(spark, RECORDS)
    return reduce(DataFrame.unionByName, loaded)
