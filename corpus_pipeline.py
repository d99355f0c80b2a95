"""From raw documents to packed sequences, in five stages.

Each stage reads what the one before it kept. ``run`` stores the documents after each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from replylens.llm import exact, jaccard, langid, packing, quality
from replylens.llm.common import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; references come from the documents given."""
    return quality.keep_good(docs, quality.fit_references(docs))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with profiles of the documents given."""
    return langid.keep_identified(docs, langid.fit_profiles(docs, F.lit(True)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by five-word shingles at 0.8 or more, the smallest id."""
    return jaccard.keep_one_of_each(docs, words=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("best_fit_packing", pack),
]

# Fitted references, vectors and tokens have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
