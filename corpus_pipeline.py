"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination and BPE encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.llm.common import materialize
from gridwatch.llm.encode import bpe_encode
from gridwatch.llm.leaks import leaks
from gridwatch.llm.lines import NO_ID, kept_text, line_dedup
from gridwatch.llm.neardup import near_duplicates
from gridwatch.llm.quality import quality_kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keys(docs: DataFrame) -> DataFrame:
    """did and th beside the columns of documents, to join what an operator said on."""
    return docs.select(*COLUMNS).withColumns({"did": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "th": F.xxhash64("text")})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, row by row. Null and empty texts have too few words and go; repeated rows stay."""
    return quality_kept(docs.select(*COLUMNS))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share, but for the first document of each; n_chars is counted anew.

    Documents that lost lines and have no word left go: others keep all that they said. A null text becomes
    an empty one. Repeated rows (one id, one text) stay repeated; their first lines stay in each.
    """
    found = kept_text(line_dedup(docs, keep_first=True, carry=("lang", "source")))
    left = found.filter((F.col("n_dropped") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    return left.select("doc_id", F.col("kept").alias("text"), "carried.lang", "carried.source", F.length("kept").cast("long").alias("n_chars"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the least id's, of its texts the one of least hash, of its rows the least.

    Texts without words link with nothing and stay, one row for each id and text. A null id is the least.
    """
    said = near_duplicates(docs).filter("kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "component", "th")
    with_words = said.filter("component is not null").groupBy("component", "did").agg(F.min("th").alias("th")).select("did", "th")
    picked = with_words.unionByName(said.filter("component is null").select("did", "th").distinct())
    one = _keys(docs).join(picked, ["did", "th"], "left_semi").groupBy("did", "th")
    least = one.agg(F.min("text").alias("text"), F.min(F.struct("lang", "source", "n_chars")).alias("rest"))
    return least.select(F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "text", "rest.lang", "rest.source", "rest.n_chars")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, row by row. Null and empty texts hold none; repeated rows stay or go together."""
    held = leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), "th").distinct()
    return _keys(docs).join(held, ["did", "th"], "left_anti").select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian unsigned 32-bit), decoded, row by row; a null text has no ids."""
    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near), ("decontamination", decontaminate), ("bpe_encoding", encode)]

#: SQL can't compress or encode; each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
