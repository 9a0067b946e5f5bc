"""Run plan per dataset, from its row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions import plan_math as pm


def run_plan(
    counts: DataFrame, rows: str = "n_rows", batch: int = 1, accumulate: int = fv.GRAD_ACCUM,
    epochs: int = fv.EPOCHS, fixed_steps: int | None = None,
) -> DataFrame:
    """Add steps, floors, caps, warm-up and schedule to a table of row counts.

    With ``fixed_steps`` the epochs follow from the steps; otherwise the steps
    follow from the epochs.
    """
    n, steps = F.col(rows), F.col("steps_per_epoch")
    if fixed_steps is None:
        total, rounds = steps * epochs, F.lit(epochs).cast("bigint")
    else:
        total = F.lit(fixed_steps).cast("bigint")
        rounds = F.greatest(F.lit(1).cast("bigint"), pm.whole(total / F.greatest(steps, F.lit(1))))
    planned = counts.withColumn("steps_per_epoch", pm.epoch_steps(n, batch, accumulate)).withColumns(
        {"total_steps": total, "epochs": rounds}
    )
    all_steps = F.col("total_steps")
    return planned.withColumns({
        "floor_fraction": pm.floor_fraction(F.greatest(steps, F.lit(1))),
        "min_stop_step": pm.min_stop_step(steps),
        "hard_cap_fraction": pm.hard_cap_fraction(all_steps),
        "hard_cap_step": pm.whole(all_steps * pm.hard_cap_fraction(all_steps)),
        "warmup_steps": pm.warmup_steps(all_steps),
        "schedule": pm.schedule_name(n, F.col("epochs"), pm.min_stop_step(steps)),
    })
