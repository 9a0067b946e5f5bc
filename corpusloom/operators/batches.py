"""Batches of rows of similar length, and their padding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.labels import pad, padded_width
from corpusloom.operators.ordering import shuffle_key
from corpusloom.operators.series import number_in_group

LAST_BUCKET = 4095
BATCH_KEYS = ["bucket", "part", "batch"]


def row_hash(*keys: str) -> Column:
    """A well spread whole number from the row key."""
    joined = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def length_batches(
    df: DataFrame, key: str | Sequence[str], batch_size: int, length: str = "length", bucket_width: int | None = 64,
    part_rows: int = 65536,
) -> DataFrame:
    """Put every row into one batch of up to ``batch_size`` similar rows.

    Rows fall into buckets of ``bucket_width`` lengths (the last bucket is
    open), and a bucket with more than ``part_rows`` rows is split by a hash
    of the key into parts of about that size, so no bucket is sorted in one
    task.  With ``bucket_width=None`` lengths are ignored and the order is
    random, which is the baseline that grouping is measured against.  ``key``
    is one column or several that together are unique.
    """
    keys = [key] if isinstance(key, str) else list(key)
    needed = F.ceil(F.count("*") / part_rows).cast("bigint").alias("_parts")
    if bucket_width is None:
        order = [F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))]
        parted = df.withColumns({"bucket": F.lit(0), "_parts": df.agg(needed).scalar()})
    else:
        order = [F.desc(length)]
        bucket = F.least(F.floor(F.col(length) / bucket_width), F.lit(LAST_BUCKET)).cast("int")
        rows = df.withColumn("bucket", bucket)
        # At most LAST_BUCKET + 1 rows, so safe to broadcast.
        parted = rows.join(F.broadcast(rows.groupBy("bucket").agg(needed)), "bucket")
    placed = parted.withColumn("part", F.pmod(row_hash(*keys), F.col("_parts")).cast("int"))
    within = F.row_number().over(Window.partitionBy("bucket", "part").orderBy(*order, *keys))
    return placed.withColumns({
        "batch": F.floor((within - 1) / batch_size).cast("int"),
        "slot": ((within - 1) % batch_size).cast("int"),
    }).drop("_parts")


def trainer_order(
    df: DataFrame, key: str | Sequence[str], batch_size: int, seed: int, length: str = "length", batches: int = 50,
    levels: Sequence[int] = (2, 5),
) -> DataFrame:
    """The order in which a trainer that groups by length takes the rows: ``position`` and ``batch``, from 0.

    A seeded permutation is cut into groups of ``batches`` batches (fewer for
    a table of under four groups of that size), each group is sorted by falling
    length, and the longest row of all changes places with the first one, so
    that a lack of memory shows at once.  The permutation is the order of a
    hash of seed and key; rows are numbered by ranges of the hash, ``levels``
    hex digits from coarse to fine, so no task sorts more than a group or the
    rows of one range.  Keys must be unique.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_key", shuffle_key(seed, *keys))
    ranges = [F.substring("_key", 1, digits) for digits in levels]
    # One group of all rows: every hash is as long.
    numbered = number_in_group(hashed.withColumn("_all", F.length("_key")), "_all", ["_key", *keys], ranges, "_n")
    n_rows = df.count()
    size = max(1, min(n_rows // (batch_size * 4), batches)) * batch_size
    grouped = numbered.withColumn("_group", F.floor((F.col("_n") - 1) / size))
    inside = Window.partitionBy("_group").orderBy(F.desc(length), "_n")
    placed = grouped.withColumn("position", F.col("_group") * size + F.row_number().over(inside) - 1)
    # The first row of each group is its longest; of equal ones the first group's counts.
    heads = placed.filter(F.col("position") % size == 0)
    longest = heads.orderBy(F.desc(length), "position").select("position").first()
    at = longest["position"] if longest else 0
    position = F.when(F.col("position") == at, 0).when(F.col("position") == 0, at).otherwise(F.col("position")).cast("bigint")
    return placed.withColumn("position", position).withColumn("batch", F.floor(F.col("position") / batch_size)).select(
        *df.columns, "position", "batch")


def padded_rows(batched: DataFrame, pad_id: int = 0, rebuild_labels: bool = True) -> DataFrame:
    """Pad each row to the width of its batch.

    The width is the longest row of the batch rounded up to a multiple of
    eight.  Labels come from the ids, or are the row's own labels when
    ``rebuild_labels`` is false; padding is masked out of both.
    """
    size = F.size("input_ids")
    longest = F.max(size).over(Window.partitionBy(*BATCH_KEYS))
    sized = batched.withColumn("width", padded_width(longest))
    width = F.col("width")
    source = F.col("input_ids") if rebuild_labels else F.col("labels")
    return sized.withColumns({
        "n_tokens": size,
        "labels": pad(source, width, fv.IGNORE_LABEL),
        "attention_mask": pad(F.col("attention_mask"), width, 0),
        "input_ids": pad(F.col("input_ids"), width, pad_id),
    })


def padded_batches(batched: DataFrame, pad_id: int = 0, rebuild_labels: bool = True) -> DataFrame:
    """One row per batch with rectangular id, mask and label matrices.

    A batch holds at most its batch size of rows, so gathering it is bounded.
    """
    cells = F.struct("slot", "input_ids", "attention_mask", "labels")
    gathered = padded_rows(batched, pad_id, rebuild_labels).groupBy(*BATCH_KEYS).agg(
        F.sort_array(F.collect_list(cells)).alias("_rows"), F.first("width").alias("width")
    )
    matrices = [
        F.col("_rows").getField(name).alias(name)
        for name in ("input_ids", "attention_mask", "labels")
    ]
    return gathered.select(*BATCH_KEYS, "width", F.size("_rows").alias("n_rows"), *matrices)


def padding_efficiency(batched: DataFrame, label: str) -> DataFrame:
    """Real and padded token counts over all batches of one arrangement."""
    per_batch = batched.groupBy(*BATCH_KEYS).agg(
        F.sum(F.size("input_ids")).alias("_real"),
        (padded_width(F.max(F.size("input_ids"))) * F.count("*")).alias("_padded"),
    )
    return per_batch.agg(
        F.lit(label).alias("arrangement"), F.count("*").alias("n_batches"),
        F.sum("_real").alias("real_tokens"), F.sum("_padded").alias("padded_tokens"),
        F.round(F.sum("_real") / F.sum("_padded"), 4).alias("efficiency"),
    )
