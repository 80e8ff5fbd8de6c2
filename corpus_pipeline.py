"""The corpus pipeline: documents in, packed sequences out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontam, packing, pii, quality, queries, simhash
from gridloom.llm.common import documents
from gridloom.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontam.keep_clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and words that disclose it taken out of their texts, and their new length."""
    return pii.sanitise(docs).withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in as few sequences as the search finds."""
    return packing.pack_documents(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("rule_ensemble", good_texts),
    ("simhash_near_copies", one_of_each),
    ("latent_decontamination", without_benchmark),
    ("disclosure_spans", sanitised),
    ("best_fit_packing", packed),
]

# Trained scores, fingerprints and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
