"""Ordered work inside groups of any size.

One group may hold a large share of all rows, so nothing here sorts a whole
group in one task.  Groups are cut into blocks of bounded size, each block is
handled on its own, and only one small row per block is combined per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "_block"
BORROWED = "_borrowed"


def next_in_group(
    df: DataFrame, group: str, position: str, columns: Sequence[str], block_size: int = 1024
) -> DataFrame:
    """Add ``next_<column>`` from the following row of the group.

    ``position`` is a number, unique within the group.  Blocks are ranges of
    positions; the last row of a block looks at a borrowed copy of the next
    block's first row.  Groups that end before ``block_size`` need no copies,
    and the copies come from a scan filtered on ``position``.
    """
    block = F.greatest(F.floor(F.col(position) / block_size), F.lit(0))
    rows = df.withColumn(BLOCK, block).withColumn(BORROWED, F.lit(False))
    heads = (
        df.filter(F.col(position) >= block_size)
        .groupBy(group, block.alias(BLOCK))
        .agg(F.min_by(F.struct(position, *columns), position).alias("_head"))
    )
    earlier = F.lag(BLOCK, 1, 0).over(Window.partitionBy(group).orderBy(BLOCK))
    borrowed = heads.select(
        group, "_head.*", earlier.alias(BLOCK), F.lit(True).alias(BORROWED)
    )
    ordered = Window.partitionBy(group, BLOCK).orderBy(position)
    both = rows.unionByName(borrowed, allowMissingColumns=True)
    following = {f"next_{c}": F.lead(c).over(ordered) for c in columns}
    return both.withColumns(following).filter(~F.col(BORROWED)).drop(BLOCK, BORROWED)


def number_in_group(
    df: DataFrame, group: str, order: Sequence[str], blocks: Sequence[Column], name: str = "n"
) -> DataFrame:
    """Number the rows of each group from 1 in the given order.

    ``blocks`` go from coarse to fine, and none may fall as the order rises.
    Rows are numbered inside their finest block; the rows of earlier blocks
    are added from counts, level by level, so that each sum runs over the
    blocks of one coarser block only.
    """
    levels = [f"{BLOCK}{i}" for i in range(len(blocks))]
    rows = df.withColumns(dict(zip(levels, blocks)))
    finest = rows.groupBy(group, *levels).agg(F.count("*").alias("_size"))

    def offsets(sizes: DataFrame, keys: list[str]) -> DataFrame:
        """Rows before each block, from the sizes of blocks under ``keys``."""
        before = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        placed = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        if len(keys) == 2:
            return placed
        coarse = sizes.groupBy(*keys[:-1]).agg(F.sum("_size").alias("_size"))
        above = offsets(coarse, keys[:-1]).select(*keys[:-1], F.col("_before").alias("_above"))
        return placed.join(above, keys[:-1]).withColumn("_before", F.col("_before") + F.col("_above")).drop("_above")

    keys = [group, *levels]
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        rows.withColumn("_inside", inside)
        .join(offsets(finest, keys).drop("_size"), keys)
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop(*levels, "_before", "_inside")
    )
