"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm import decontaminate, language, packing, simhash, suffix_dedup
from shelfmatch.llm.common import prepared, table
from shelfmatch.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that no learned language comes near enough to."""
    prepared(spark)
    return language.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id: four-word shingles, four bits apart."""
    prepared(spark)
    return simhash.one_of_each_group(docs, width=4, distance=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has go; so do documents with nothing else."""
    prepared(spark)
    return suffix_dedup.without_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences of permitted lengths."""
    prepared(spark)
    return packing.pack(docs, packing.word_count(F.col("text")))


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL has no word for the language model, the edit budget or the packing rule; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
