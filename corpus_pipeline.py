"""The corpus pipeline: documents whose language can be told, one of each group of near copies, none that holds a benchmark
item, with live-looking credentials redacted, encoded for training."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, langid, secrets, sentences, simhash
from tickloom.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a tellable language go."""
    return langid.keep_identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, the one with the least id."""
    return simhash.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that few owners hold are replaced; every document stays."""
    return secrets.redact_live(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as SentencePiece ids."""
    return sentences.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secret_scan", redact_secrets),
    ("sentencepiece", encode_texts),
]

#: Learned models, shingle similarity, edit distance and piece ids are beyond SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
