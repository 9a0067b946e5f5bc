"""Token counts, their percentiles and the length cap."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from corpusloom import fixed_values as fv
from corpusloom.functions.word_lists import token_counts
from corpusloom.session import ship_package

POINTS = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def token_length(text: Column, n_special: int = 1) -> Column:
    """Untruncated token count including special tokens, counted in Python on Arrow batches."""
    def work(texts: pa.Array) -> pa.Array:
        return token_counts(texts, n_special)
    ship_package(SparkSession.active())
    return F.arrow_udf(work, IntegerType())(text)


def length_percentiles(
    lengths: DataFrame, by: Sequence[str] = (), length: str = "length", weight: Column | None = None
) -> DataFrame:
    """p50, p95 and p99 of ``length``, interpolated and cut to whole numbers.

    Rows are first counted per distinct length, so what reaches the last
    stage of a group is one row per length and not one per text.  ``weight``
    is the number of texts that a row stands for.  No rows at all is an error.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    counted = lengths.groupBy(*by, length).agg(rows.alias("_rows"))
    points = F.percentile(length, list(POINTS.values()), F.col("_rows"))
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    checked = counted.groupBy(*by).agg(points.alias("_points"), total.alias("n_rows"))
    if not by:
        failure = F.raise_error(F.lit("no rows to measure lengths from")).cast("array<double>")
        checked = checked.withColumn(
            "_points", F.when(F.col("n_rows") == 0, failure).otherwise(F.col("_points"))
        )
    named = [
        F.floor(F.get("_points", F.lit(i))).cast("int").alias(name)
        for i, name in enumerate(POINTS)
    ]
    return checked.select(*by, "n_rows", *named)


def counted_lengths(lengths: DataFrame, by: str, total: str, length: str = "length") -> DataFrame:
    """Rows per group and length, and once more under the group ``total``: one scan serves both."""
    counted = lengths.groupBy(by, length).agg(F.count("*").alias("_rows"))
    return counted.withColumn(by, F.explode(F.array(F.col(by), F.lit(total))))


def length_cap(
    lengths: DataFrame, by: Sequence[str] = (), length: str = "length", weight: Column | None = None
) -> DataFrame:
    """The percentiles with ``max_length``: p95 held between the fixed bounds."""
    measured = length_percentiles(lengths, by, length, weight)
    cap = F.greatest(F.lit(fv.MIN_CAP), F.least(F.lit(fv.MAX_CAP), F.col("p95")))
    return measured.withColumn("max_length", cap.cast("int"))


def cap_value(lengths: DataFrame, length: str = "length") -> Column:
    """The global cap as a value usable in any expression, still lazy."""
    return length_cap(lengths, length=length).select("max_length").scalar()
