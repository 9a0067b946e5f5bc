"""Seeded row order and the one-row preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import clean_text


def shuffle_key(seed: int, *keys: str) -> Column:
    """A pseudo-random sort key, the same for the same seed and row key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def seeded_shuffle(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """The whole table in a seeded random order."""
    return df.withColumn("shuffle_key", shuffle_key(seed, *keys)).orderBy("shuffle_key", *keys)


def shorten(text: Column, limit: int = fv.PREVIEW_CHARS) -> Column:
    """The first ``limit`` characters, with an ellipsis when more follow."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))).otherwise(text)


def preview(
    df: DataFrame, question: str, answer: str, seed: int, *keys: str, mode: str = "math"
) -> DataFrame:
    """The first row of the shuffled order, cleaned and shortened."""
    first = df.orderBy(shuffle_key(seed, *keys), *keys).limit(1)
    return first.select(
        *keys,
        shorten(clean_text(F.col(question), mode)).alias("question"),
        shorten(clean_text(F.col(answer), mode)).alias("answer"),
    )
