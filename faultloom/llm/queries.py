"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from faultloom.llm import collocations, decontamination, lines, minhash, ngrams, packing, quality, sharding, simhash, spelling, suffixes, toxicity, warc
from faultloom.llm.common import table


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.dedup_documents(table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), misspell=199)


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": Query(op1_packing),
    "op2_minhash": Query(op2_minhash),
    "op3_warc": Query(op3_warc, warc.ORACLE_SQL),
    "op4_toxicity": Query(op4_toxicity),
    "op5_sharding": Query(op5_sharding),
    "op6_line_dedup": Query(op6_line_dedup, lines.oracle_sql()),
    "op7_lm_scoring": Query(op7_lm_scoring),
    "op8_quality_rules": Query(op8_quality_rules, quality.oracle_sql()),
    "op9_suffix_dedup": Query(op9_suffix_dedup),
    "op11_collocations": Query(op11_collocations, collocations.oracle_sql()),
    "op12_spelling": Query(op12_spelling),
    "op13_simhash": Query(op13_simhash),
    "op10_decontamination": Query(op10_decontamination, decontamination.oracle_sql()),
}
