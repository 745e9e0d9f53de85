"""The corpus pipeline: each stage works on what its predecessor kept, written as Parquet and read again in between."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larder.llm import mixing, near_dedup, packing, pii, quality_rules
from larder.llm.common import stage


#: Bytes of words that a packing task remembers: less than on its own, as the workers hold what former stages needed.
WORDS_IN_MEMORY = 24_000_000
#: Texts that go to a Python worker at once. Batches lie outside the heap, and what they took is kept for the next stage.
TEXTS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """For the rest of the session: it is when a stage's result is written that most of its batches are made."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles, directly or by others, the one of smallest id stays."""
    small_batches(spark)
    return near_dedup.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers, and terms that disclose them, are replaced in the texts. Every document stays."""
    small_batches(spark)
    return pii.sanitize(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources reach their target weights: whole repetitions are rows, a fractional one is a row with the leading words."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their ids and places in sequences. Each repetition of a document is packed on its own."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, remembered=WORDS_IN_MEMORY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Tokenizing can't be written in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
