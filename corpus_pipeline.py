"""The corpus pipeline: stages over ``documents``, each reading what the one before wrote.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
The result has one row per document copy that is left, with its ids. SQL can't express the stages, so tests
compare the pipeline with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.catalog import load, stage
from lodestone.llm import bpe, line_dedup, mixing, quality, queries, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from labelled documents outside the held-out fold."""
    return quality.accepted(docs, quality.train(docs, load(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are similar to an earlier line go; every document stays, and n_chars follows its text."""
    out = line_dedup.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else out


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies of an earlier document go: those within four bits, and those with 0.8 of the five-word shingles in common."""
    return simhash.keep_first(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that the languages' tokens meet their target shares."""
    return mixing.mix(docs, mixing.fit(docs, load(spark, sf_dir, "labels")))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to as a digest."""
    return bpe.bpe_frame(docs, queries.vocabulary(), ("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each result is written and reread."""
    docs = load(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}", spark)
    return docs
