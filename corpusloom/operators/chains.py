"""Reset chains over whole tables: summaries per block, joined per group.

The pieces handed to Python are a block of records, or up to ``FAN`` block
summaries; one summary per ``FAN`` blocks (about a million records) comes
together for a whole group.  A summary holds the levels that an incoming value
can meet, which a series passes in the time it takes to move by the smallest
counted drop; two summaries are joined by one sorted lookup.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import reset_chain as rc
from corpusloom.session import ship_package

FAN = 1024
KEYS = "run_id bigint, block bigint"
SUMMARY_COLUMNS = [*rc.FIELDS, "tail_end"]


def map_groups(
    df: DataFrame, keys: Sequence[str], order: str, work: Callable[[dict], dict], schema: str
) -> DataFrame:
    """Run ``work`` on every group: columns as arrays in, columns out.

    The window brings the rows of a group together in order, and costs no
    shuffle where they are partitioned that way already.  Python then gets
    Arrow batches that hold many groups, so small groups cost little; a group
    that a batch cuts off waits for the next batch.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1
    names = [field.split()[0] for field in schema.split(", ")]

    def run(frames):
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            starts = np.flatnonzero(frame["_first"].to_numpy(bool))
            held = frame.iloc[starts[-1]:]
            if len(starts) > 1:
                yield each(frame, starts)
        if held is not None:
            yield each(held, np.array([0, len(held)]))

    def each(frame, edges):
        arrays = {name: frame[name].to_numpy() for name in frame.columns}
        out = {name: [] for name in names}
        for low, high in zip(edges, edges[1:]):
            made = work({name: values[low:high] for name, values in arrays.items()})
            for name in names:
                out[name].extend(made[name])
        return pd.DataFrame({
            name: pd.Series(values, dtype=object if name in SUMMARY_COLUMNS else None)
            for name, values in out.items()
        })

    ship_package(df.sparkSession)
    made = df.withColumn("_first", first).mapInPandas(run, schema)
    # Pandas takes undefined numbers for missing ones; no number here is missing.
    numbers = [name for name, kind in made.dtypes if kind == "double"]
    return made.withColumns({name: F.coalesce(name, F.lit(float("nan"))) for name in numbers})


def summary_row(summary: dict, **keys) -> dict:
    """A summary as one output row after its key columns."""
    return {k: [v] for k, v in {**keys, **summary}.items()}


def _summaries(rows: dict) -> list[dict]:
    found = [dict(zip(SUMMARY_COLUMNS, values)) for values in zip(*(rows[c] for c in SUMMARY_COLUMNS))]
    for summary in found:
        summary["values"] = np.asarray(summary["values"], dtype=float)  # None becomes NaN
        end = summary["tail_end"]
        summary["tail_end"] = None if pd.isna(end) else int(end)
    return found


def joined_by_fan(summaries: DataFrame) -> DataFrame:
    """One summary per group and run of ``FAN`` blocks."""
    def join_all(rows):
        whole, *others = _summaries(rows)
        for part in others:
            whole = rc.join(whole, part)
        return summary_row(whole, run_id=rows["run_id"][0], fan=rows["fan"][0])

    keyed = summaries.withColumn("fan", F.floor(F.col("block") / FAN))
    return map_groups(
        keyed, ["run_id", "fan"], "block", join_all, f"run_id bigint, fan bigint, {rc.SUMMARY}"
    )


def chain_ends(summaries: DataFrame, start: float) -> DataFrame:
    """The mark at which each group's chain ends; groups that never end are left out."""
    def last(rows):
        x = start
        for summary in _summaries(rows):
            x, mark, ended = rc.apply(summary, x)
            if ended:
                return {"run_id": rows["run_id"][:1], "end_mark": [mark]}
        return {"run_id": [], "end_mark": []}

    return map_groups(
        joined_by_fan(summaries), ["run_id"], "fan", last, "run_id bigint, end_mark bigint"
    )


def chain_values(summaries: DataFrame, starts: DataFrame) -> DataFrame:
    """``run_id, value, end_mark``: the value that each group's chain leaves, and -1 or where it ended.

    ``starts`` has ``run_id, value``, the value with which a group begins.
    """
    def walk(rows):
        x, end_mark = float(rows["value"][0]), -1
        for summary in _summaries(rows):
            x, mark, ended = rc.apply(summary, x)
            if ended:
                end_mark = mark
                break
        return {"run_id": rows["run_id"][:1], "value": [x], "end_mark": [end_mark]}

    # Pandas has one missing value for null and NaN; no reference is null.
    begun = joined_by_fan(summaries).join(starts.select("run_id", "value"), "run_id")
    return map_groups(begun, ["run_id"], "fan", walk, "run_id bigint, value double, end_mark bigint")
