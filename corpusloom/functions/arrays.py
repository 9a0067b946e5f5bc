"""Numeric expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import bind


def cross_entropy(logits: Column, label: Column) -> Column:
    """Loss of one position: log of the summed exponents minus the label's logit."""
    def loss(x: Column) -> Column:
        top = F.array_max(x)
        total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))
        return F.ln(total) + top - F.get(x, label)
    return bind(logits.cast("array<double>"), loss)
