"""From raw documents to training text in five stages, each of one operator of millrace.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, jaccard_join, quality, segmentations, surrogates
from millrace.llm.queries import KEY
from millrace.llm.shared import written


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars of its text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above their host's limits are cut from the others."""
    return _counted(quality.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return jaccard_join.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut; documents that are little else go."""
    return _counted(decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates."""
    return _counted(surrogates.pseudonymise(docs, key=KEY).select(docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, with their scores."""
    found = segmentations.sampled(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "rank", "ids", F.round("log_prob", 6).alias("log_prob"), F.round("score", 6).alias("score"), F.round("inclusion", 6).alias("inclusion"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", encode),
]
#: SQL has no segmentations by these random numbers; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
