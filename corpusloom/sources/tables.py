"""Reading Parquet training tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_training_table(spark: SparkSession, *paths: str) -> DataFrame:
    """A training table from Parquet files, folders or globs.

    A path that names a file of another kind is refused.
    """
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if "." in name and not any(c in name for c in "*?[{") and not name.lower().endswith(".parquet"):
            raise ValueError(f"not a Parquet path: {path}")
    return spark.read.parquet(*paths)


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Column names from the file footers, without reading rows."""
    return spark.read.parquet(path).columns


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = TEST_TABLES
) -> dict[str, DataFrame]:
    """Tables stored as ``<folder>/<name>.parquet``."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
