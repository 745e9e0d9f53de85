"""One registered query per operator: its production parameters on its whole table, as (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import language_id, license_scan, lm_scoring, mixing, near_dedup, packing, pii, quality_rules, spelling, substring_dedup, toxicity, vp_search, whitening
from larder.llm.common import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, F.round("quality", 4).alias("quality"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir)).withColumn("n_spans", F.size("spans")).drop("spans")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept_text")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_vp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir), across=True)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(documents(spark, sf_dir), shingle=4, threshold=80)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(documents(spark, sf_dir)).drop("terms")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.withColumn("n_matches", F.size("matches")).drop("matches")


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_language_id, op3_substring_dedup, op4_packing, op5_license_scan,
    op6_mixing, op7_vp_search, op8_lm_scoring, op9_near_dedup, op10_pii,
    op11_whitening, op12_spelling, op13_toxicity,
)}
