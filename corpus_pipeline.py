"""The corpus pipeline: quality, near duplicates, benchmark, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept. All
but the last give rows with the columns of `documents`. Nulls, empty texts and repeated rows are
treated as the operators say; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import bpe, decontam, jaccard, quality, secrets
from wordmill.llm.common import scratch, table, written
from wordmill.llm.queries import BYTE_BPE


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and the forest keep; labels calibrate it."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each component of near duplicates."""
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in windows of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    masked = secrets.redact(docs, secrets.fit(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of all documents."""
    coded = bpe.encode(docs, BYTE_BPE)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_copies),
    ("benchmark", drop_benchmark),
    ("secrets", mask_secrets),
    ("tokens", to_tokens),
]

#: The stages fit models and tokenize, which SQL cannot express; tests hold them against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of a folder; each is written first."""
    folder = scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
