"""Run-planning and monitor-window arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv


def whole(value: Column) -> Column:
    """Cut to a whole number; the inputs here are never negative."""
    return F.floor(value).cast("bigint")


def epoch_steps(rows: Column, batch: int, accumulate: int) -> Column:
    return whole(rows / (batch * accumulate))


def floor_fraction(steps: Column) -> Column:
    return F.when(steps < fv.FLOOR_SWITCH, F.lit(fv.FLOOR_SMALL)).otherwise(F.lit(fv.FLOOR_LARGE))


def min_stop_step(steps: Column) -> Column:
    at_least_one = F.greatest(steps, F.lit(1))
    return F.greatest(
        whole(at_least_one * floor_fraction(at_least_one)), F.lit(fv.MIN_STOP_STEPS).cast("bigint")
    )


def hard_cap_fraction(total: Column) -> Column:
    """Falls from the high to the low cap between 10 and 100,000 steps."""
    reach = (F.log10(F.greatest(total, F.lit(10)).cast("double")) - 1) / 4
    scale = F.greatest(F.least(reach, F.lit(1.0)), F.lit(0.0))
    return F.bround(F.lit(fv.HARD_CAP_HIGH) - F.lit(fv.HARD_CAP_HIGH - fv.HARD_CAP_LOW) * scale, 4)


def warmup_steps(total: Column) -> Column:
    return F.greatest(F.lit(fv.MIN_WARMUP).cast("bigint"), whole(total * fv.WARMUP_FRACTION))


def schedule_name(rows: Column, epochs: Column, stop_step: Column) -> Column:
    """Name of the learning-rate schedule.

    The restart branch needs a pressure of at most .18 and above a third at
    once, so it never applies; it is kept because it is part of the rule.
    """
    exposure = F.greatest(rows, F.lit(1)) * F.greatest(epochs, F.lit(1))
    pressure = stop_step / exposure
    restarts = (
        exposure.between(1500, 40000) & (epochs >= 2)
        & (pressure <= fv.RESTART_PRESSURE) & (exposure / 3 < stop_step)
    )
    return (
        F.when((exposure < 1500) | (epochs <= 1), "linear")
        .when(pressure >= fv.LINEAR_PRESSURE, "linear")
        .when(restarts, "cosine_with_restarts")
        .otherwise("cosine")
    )


def monitor_window(steps: Column, window: int = fv.MONITOR["window"]) -> Column:
    """Look-back of the spread estimate, longer for longer runs."""
    scaled = F.greatest(F.lit(96).cast("bigint"), whole(F.greatest(steps, F.lit(1)) * 0.015))
    return F.greatest(F.lit(min(window, 512)).cast("bigint"), scaled)


def slope_window(window: Column) -> Column:
    return F.greatest(F.lit(48).cast("bigint"), whole(window * 0.75))


def history_needed(window: Column) -> Column:
    return F.greatest(F.lit(24).cast("bigint"), whole(window / 3))
