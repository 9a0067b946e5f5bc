"""Whitening of embedding vectors along their leading principal components.

Vectors are put on a grid of whole numbers, so that counts, sums and deviations
are exact.  Two passes add up the sums and then the products of centred
vectors, one small matrix per task; the driver slices the spectrum of the
covariance (:mod:`corpusloom.llm.spectrum`), and a third pass projects.  What
reaches the driver is one covariance matrix, the size of a vector squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import PART_ROWS, map_rows, ready, record
from corpusloom.llm.spectrum import leading_pairs
from corpusloom.session import stage_table

COMPONENTS = 8
GRID, OFFSET = 1024, 100_000     # a whole number is floor(GRID * entry) + OFFSET
LARGEST = float(1 << 52)         # whole numbers up to here are exact as doubles
LONG_BITS = 62


def grid_vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``rows, x`` for each vector length of a list column: the usable rows and their whole numbers.

    A null vector, one with a null or non-finite entry, and one with an entry
    that is too large for the grid are left out.
    """
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(GRID * flat.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float))
        bad = ~(np.abs(whole) <= LARGEST)  # null entries are NaN here
    ends = np.cumsum(lengths)
    spoilt = np.concatenate([[0], np.cumsum(bad)])
    good = (spoilt[ends] == spoilt[ends - lengths]) & column.is_valid().to_numpy(zero_copy_only=False)
    found = []
    for length in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == length))
        places = (ends - lengths)[rows][:, None] + np.arange(length)
        found.append((rows, whole[places].astype(np.int64) + OFFSET))
    return found


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums`` exactly: longs where they suffice, else whole numbers of any size."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if largest >> LONG_BITS:
        return n * x.astype(object) - np.array(sums, dtype=object)
    return n * x - np.array(sums, dtype=np.int64)


def squared_length(apart: np.ndarray) -> list[int | None]:
    """Sums of squares of the rows, null where a long can't hold one."""
    rough = (apart.astype(float) ** 2).sum(axis=1)
    safe = rough < float(1 << LONG_BITS)
    exact: list[int | None] = [None] * len(apart)
    if apart.dtype != object and safe.all():
        return (apart * apart).sum(axis=1).tolist()
    for row, whole in enumerate(apart.astype(object)):
        total = sum(int(v) ** 2 for v in whole)
        exact[row] = total if total >> 63 == 0 else None
    return exact


@dataclass(frozen=True)
class Whitening:
    """What a fit found; ``axes`` has a unit vector per row, by falling ``values``."""

    n: int
    sums: list[int]
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Deviations and whitened coordinates; NaN along an axis without variance."""
        apart = centred(x, self.n, self.sums)
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = self.axes.T / np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return squared_length(apart), (apart / self.n).astype(float) @ scaled


def vector_sums(vectors: DataFrame) -> DataFrame:
    """``length, place, n, total`` of the usable vectors; place -1 stands for the vector itself."""
    ready(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in grid_vectors(batch.column(0)):
                n, high, low = found.setdefault(x.shape[1], [0, 0, 0])
                # Halves of 32 bits can't overflow within a batch.
                found[x.shape[1]] = [
                    n + len(x), high + (x >> 32).sum(axis=0).astype(object), low + (x & 0xFFFFFFFF).sum(axis=0).astype(object)]
        for length, (n, high, low) in found.items():
            totals = ["0", *[str(int(h) * (1 << 32) + int(l)) for h, l in zip(high, low)]]
            yield record(
                length=pa.array([length] * (length + 1), pa.int32()), place=pa.array(range(-1, length), pa.int32()),
                n=pa.array([n] * (length + 1), pa.int64()), total=pa.array(totals))
    parts = vectors.mapInArrow(run, "length int, place int, n bigint, total string")
    return parts.groupBy("length", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def centred_products(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The sum over all vectors of the products of their centred entries."""
    length = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((length, length))
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                for _, x in grid_vectors(batch.column(0).slice(at, PART_ROWS)):
                    if x.shape[1] == length:
                        apart = (centred(x, n, sums) / n).astype(float)
                        total += apart.T @ apart
        if total.any():
            yield record(i=pa.array(range(length), pa.int32()), v=pa.array(list(total), pa.list_(pa.float64())))
    parts = vectors.mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    made = np.zeros((length, length))
    for i, j, v in parts.groupBy("i", "j").agg(F.sum("v")).collect():
        made[i, j] = v
    return made


def fit_whitening(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """Sums, covariance and leading components of all usable vectors; None if there are none.

    Vectors of several lengths have no common covariance: the length that most
    of them have counts, the greater of equals.
    """
    vectors = df.select(F.col(vector).alias("v"))
    totals = stage_table(vector_sums(vectors), "vector-sums")
    first = totals.filter("place = -1").orderBy(F.desc("n"), F.desc("length")).first()
    if first is None:
        return None
    rows = totals.filter((F.col("length") == first["length"]) & (F.col("place") >= 0)).orderBy("place").collect()
    n, sums = first["n"], [int(r["total"]) for r in rows]
    covariance = centred_products(vectors, n, sums) / n
    values, axes = leading_pairs(covariance, most)
    trace = float(np.trace(covariance))
    values = np.where(values > len(sums) * np.finfo(float).eps * trace, values, 0.0)
    return Whitening(n, sums, values, axes, trace)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable vector.

    One row per vector and component, components numbered from 1 by falling
    variance, no more than a vector has entries.  ``deviation`` is the squared
    length of ``n * x - S``, null beyond a long.  ``whitened`` is null along a
    component without variance (fewer different vectors than components),
    ``explained`` where nothing varies at all.  ``identity_error`` is the
    largest entry by which the covariance of the whitened coordinates, taken
    over the rows returned, differs from the identity.

    Left out are null vectors, vectors with null, NaN or infinite entries or
    entries beyond 2**42, empty vectors, and vectors of another length than
    most have.  Repeated rows count as often as they occur, keys may be null,
    other columns are not looked at.  No vectors give no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"vec_id {kind}, deviation bigint, whitened array<double>"
    spark, rows = df.sparkSession, df.select(F.col(key).alias("vec_id"), F.col(vector).alias("v"))
    fitted = fit_whitening(df, vector, most)
    ready(spark)

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for places, x in grid_vectors(batch.column(1)):
            if x.shape[1] == len(fitted.sums):
                deviation, white = fitted.project(x)
                yield record(
                    vec_id=batch.column(0).take(pa.array(places)), deviation=pa.array(deviation, pa.int64()),
                    whitened=pa.array(list(white), pa.list_(pa.float64())))
    if fitted is None:
        projected = spark.createDataFrame([], schema)
        fitted, error = Whitening(0, [], np.empty(0), np.empty((0, 0)), 0.0), None
    else:
        projected = stage_table(map_rows(rows, make, schema), "whitened")
        error = identity_error(projected, int((fitted.values > 0).sum()))
    shares = [float(v / fitted.trace) if fitted.trace > 0 else None for v in fitted.values]
    explained = F.array(*[F.lit(s).cast("double") for s in shares]) if shares else F.array().cast("array<double>")
    return projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(fitted.n).cast("bigint").alias("n"), "deviation",
        F.when(~F.isnan("value"), F.col("value")).alias("whitened"), F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def identity_error(projected: DataFrame, axes: int) -> float | None:
    """The largest difference between the covariance of the first coordinates and the identity."""
    pairs = [(i, j) for i in range(axes) for j in range(i, axes)]
    if not pairs:
        return None
    white = F.col("whitened")
    found = projected.agg(*[F.covar_pop(white[i], white[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))
