"""The corpus pipeline: five stages, each the whole job of one operator on all that its
predecessor kept.

Each stage is written as Parquet in the shared checkpoint folder and read again,
so a lost executor costs at most one stage. Rows of an empty table stay none; a
null text is rejected by the first stage, so later stages don't see one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import decontaminate, language_id, pii, sentencepiece_wfst, simhash
from scriptorium.llm.common import small_batches, table
from scriptorium.session import ensure_checkpoint_dir, materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification (6) doesn't reject, unchanged."""
    small_batches(spark)
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (7), the one with the smallest doc_id, unchanged."""
    small_batches(spark)
    ensure_checkpoint_dir(spark)
    return simhash.keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages (3): hit spans are cut out, documents that are
    mostly benchmark go; clean documents are unchanged."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data (10) replaced by the kind in brackets."""
    small_batches(spark)
    return pii.redacted(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids (1), token count, and whether they decode to the text."""
    small_batches(spark)
    return sentencepiece_wfst.encode_column(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("pii", redact_personal_data),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # models, XXH64 and piece merges aren't SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
