"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read by the next.

Language ID, exact de-duplication, near-duplicate join, substring de-duplication, packing. Every stage works on all that the
one before kept, and its decisions take effect; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import exact_dedup, jaccard_join, language_id, packing, substring_dedup
from annospark.llm.common import staged, unstage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text in which no language has this share of the letters goes. Short clean texts with names and addresses stay above it.
MIN_LANGUAGE_SHARE = 1 / 3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language: a third of the letters or more in one language, in its script and likely under it."""
    return language_id.keep_known(docs, language_id.train(docs), MIN_LANGUAGE_SHARE).select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.drop_exact_copies(docs).select(COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return jaccard_join.drop_near_duplicates(docs).select(COLUMNS)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentences and passages that stand in an earlier document; a text that is empty then goes."""
    found = substring_dedup.substring_dedup(docs.select(COLUMNS)).filter(F.length(F.trim("text")) > 0)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("substring dedup", substring),
    ("packing", pack),
]

#: Language ID and packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            unstage(before)
    return STAGES[-1][1](spark, docs, sf_dir)
