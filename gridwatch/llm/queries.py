"""The registered queries of the text operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.llm.common import documents
from gridwatch.llm.count_tokens import token_counts
from gridwatch.llm.encode import bpe_encode
from gridwatch.llm.language import language_id
from gridwatch.llm.leaks import leaks
from gridwatch.llm.lines import kept_text, line_dedup
from gridwatch.llm.neardup import near_duplicates
from gridwatch.llm.negatives import hard_negatives
from gridwatch.llm.quality import quality_rules
from gridwatch.llm.ranked import lexical_search
from gridwatch.llm.scoring import lm_scores
from gridwatch.llm.shards import consistent_shards
from gridwatch.llm.substrings import substring_dedup
from gridwatch.llm.toxicity import toxicity

TOKEN_LIMIT = 1024


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text."""
    rows = bpe_encode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("th")


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consistent_shards(documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("th", "component")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("text")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_text(line_dedup(documents(spark, sf_dir)))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, with the number of toxic passages."""
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).withColumn("n_passages", F.size("passages")).drop("passages")


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_bpe_encode, op3_leaks, op4_lm_scores, op5_shards, op6_near_duplicates, op7_quality_rules, op8_token_counts, op9_line_dedup, op10_language_id,
        op11_hard_negatives, op12_ranked_search, op13_toxicity,
    )
}
