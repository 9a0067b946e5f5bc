"""The corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.byte_index import keep_first_of_groups
from corpusloom.llm.decontamination import without_contaminated
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.quality_trees import keep_good
from corpusloom.llm.registry import table, vocabulary_text
from corpusloom.llm.suffix_dedup import texts_without_repeats
from corpusloom.session import new_scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return keep_first_of_groups(docs, shingle_words=3, max_bits=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that occur more than once are cut out of the texts."""
    return texts_without_repeats(docs, span=50, unit="words")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents in sequences of 2048 tokens."""
    return pack_documents(docs, vocabulary_text(), width=2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packed),
]

ORACLE_SQL = None  # training, suffix sort and packing have no SQL form; the tests use brute-force twins


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
