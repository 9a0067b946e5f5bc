"""Connected components of an edge table, by alternating star contraction.

Every round is two aggregations and two joins over the edges; the edges shrink
towards stars, in a number of rounds that grows with the logarithm of the
longest chain.  Nothing is collected: the driver sees two sums per round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, record
from corpusloom.session import stage_table

EDGES = "a bigint, b bigint"


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node that each one reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def contract(edges: DataFrame) -> DataFrame:
    """Replace the edges of each batch by stars around their smallest node."""
    def stars(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, root = roots_of(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        moved = nodes != root
        return record(a=root[moved], b=nodes[moved])
    return map_rows(edges.select("a", "b"), stars, EDGES)


def apart(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with ``key`` under another name, and dealt by it no more.

    A join on it has to shuffle both sides, and adaptive execution can then
    split a key with many rows, as the centre of a large star.
    """
    return df.withColumn(name, F.col(key).bitwiseXOR(F.lit(0))).drop(key)


def _linked(both: DataFrame, keep) -> DataFrame:
    """Link the kept neighbours of each node, and the node, to the smallest of them."""
    least = apart(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "u", "w")
    return both.join(least, both["u"] == least["w"]).filter(keep).select(F.col("m").alias("a"), F.col("v").alias("b"))


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _linked(both, F.col("v") > F.col("u")).filter("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = apart(down.groupBy("u").agg(F.min("v").alias("m")), "u", "w")
    others = down.join(least, down["u"] == least["w"]).select(F.col("m").alias("a"), F.col("v").alias("b"))
    return others.unionByName(least.select(F.col("m").alias("a"), F.col("w").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a bigint, b bigint`` edges.

    ``component`` is the smallest node that can be reached.  Edges may be
    repeated and point either way; edges with a null end and loops are left
    out.  No edges give no rows.
    """
    clean = edges.select("a", "b").filter("a <> b")
    now = stage_table(contract(clean.distinct()), "edges")
    mark = None
    while True:
        now = stage_table(small_star(large_star(now)), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == mark:
            return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        mark = tuple(seen)
