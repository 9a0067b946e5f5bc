"""Label, mask and padding expressions over token-id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv

IDS = "array<bigint>"


def ones_mask(ids: Column) -> Column:
    """One per real token."""
    return F.array_repeat(F.lit(1).cast("bigint"), F.size(ids))


def answer_only(ids: Column, marker: int) -> Column:
    """Labels that ignore everything up to the last marker, marker included.

    Without a marker every token is supervised.
    """
    from_end = F.array_position(F.reverse(ids), F.lit(marker).cast("bigint"))
    boundary = F.size(ids) - from_end + 1
    masked = F.transform(
        ids,
        lambda x, i: F.when(i < boundary, F.lit(fv.IGNORE_LABEL).cast("bigint")).otherwise(x),
    )
    return F.when(from_end == 0, ids).otherwise(masked)


def padded_width(longest: Column, multiple: int = fv.PAD_MULTIPLE) -> Column:
    """The longest length of a batch, rounded up to a multiple."""
    return (F.ceil(longest / multiple) * multiple).cast("int")


def pad(values: Column, width: Column, filler: int) -> Column:
    """A list filled on the right up to ``width``."""
    missing = F.greatest(width - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(filler).cast("bigint"), missing))
