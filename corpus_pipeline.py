"""Corpus preparation: quality rules, line dedup, near-dedup, decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and is written as Parquet before the next reads it. All but the last return the
columns of documents; the last returns the columns of the BPE query. Rows with null ids or texts are handled as each
operator states; stages never sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import bpe, decontamination, line_dedup, near_dedup, quality_rules
from shelfmark.llm.common import discard, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the risk-controlled rules keep; the cutoffs come from the labels."""
    return quality_rules.apply_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one has."""
    return line_dedup.dedup_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.digests(docs, bpe.vocabulary_path())


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("bpe", tokenize),
]
#: Components and merges can't be written as one SQL statement; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. Each stage's table goes once the next is stored; the last one's input stays for the lazy result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
