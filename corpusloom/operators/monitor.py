"""Smoothed loss, spread, slope, gates and the stop decision, in batch.

A log is a table ``run_id, step, loss, lr``.  One run may hold a large share
of all records, so every operator works on blocks of a run: what a block needs
from earlier ones is one carry row per block plus a bounded number of borrowed
records.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions import plan_math as pm
from corpusloom.functions import reset_chain as rc
from corpusloom.functions.windows import sigma_of_last, slope_of_last
from corpusloom.operators.chains import KEYS, chain_ends, map_groups, summary_row
from corpusloom.operators.series import number_in_group

NO_RESULT = 290.0  # powers of ten that a double can hold, with a margin
EARLIER, TAIL = "_earlier", "_tail"  # marks of rows that stand for records handled before
PER_RUN = ["steps_total", "warmup", "hard_cap_step", "window", "slope_window", "history"]


@dataclass(frozen=True)
class MonitorSettings:
    """Settings of the monitor; the defaults are the values used at call time.

    The fields in ``PER_RUN`` may differ from run to run: ``runs``, a table
    ``run_id`` and those fields, then takes their place.
    """

    steps_total: int = 1
    warmup: int = 0
    hard_cap_step: int | None = None
    exposure_floor: float = fv.MONITOR["exposure_floor"]
    lr_fraction: float = fv.MONITOR["lr_fraction"]
    beta: float = fv.MONITOR["beta"]
    sigma_floor: float = fv.MONITOR["sigma_floor"]
    min_drop: float = fv.MONITOR["min_drop"]
    min_sigmas: float = fv.MONITOR["min_sigmas"]
    slope_threshold: float = fv.MONITOR["slope_threshold"]
    patience: int = fv.MONITOR["patience"]
    cooldown: int = fv.MONITOR["cooldown"]
    window: int = 128
    slope_window: int = 96
    history: int = 42
    block_rows: int = 1024
    runs: DataFrame | None = None

    @classmethod
    def for_run(cls, steps_total: int, window: int = fv.MONITOR["window"], **options) -> MonitorSettings:
        """Settings whose windows grow with the length of the run."""
        window = max(min(window, 512), 96, int(0.015 * max(1, steps_total)))
        sizes = {"window": window, "slope_window": max(48, int(0.75 * window)), "history": max(24, window // 3)}
        return cls(steps_total=max(1, steps_total), **{**sizes, **options})

    @classmethod
    def for_runs(cls, plan: DataFrame, **options) -> MonitorSettings:
        """Settings of many runs from their plan.

        ``plan`` has ``run_id, total_steps, warmup_steps, hard_cap_step``, as
        the run plan makes them; windows follow from the steps.
        """
        steps = F.greatest(F.col("total_steps"), F.lit(1))
        window = pm.monitor_window(steps)
        runs = plan.select(
            "run_id", steps.alias("steps_total"), F.col("warmup_steps").alias("warmup"), "hard_cap_step",
            window.alias("window"), pm.slope_window(window).alias("slope_window"),
            pm.history_needed(window).alias("history"))
        # One number for all runs: the longest window, a hundredth and a half of the longest run.
        longest = runs.agg(F.max(F.greatest("window", "slope_window"))).first()[0] or 128
        return cls(runs=runs, window=int(longest), **options)

    @property
    def lookback(self) -> int:
        """Earlier records that the windows of one record reach back to."""
        return max(self.window, self.slope_window) - 1

    @property
    def window_rows(self) -> int:
        """Rows of a block of windows; never below the lookback."""
        return max(self.block_rows, self.lookback)

    @property
    def smooth_rows(self) -> int:
        """Rows of a block of the moving average, short enough for powers of ``beta`` in a double."""
        if not 0 < self.beta < 1:
            raise ValueError("beta must lie between 0 and 1")
        return max(1, min(self.block_rows, int(NO_RESULT / -math.log10(self.beta))))

    def on(self, records: DataFrame) -> DataFrame:
        """Records with the settings of their run in columns that begin with ``_``."""
        if self.runs is None:
            return records.withColumns({
                f"_{name}": F.lit(getattr(self, name)).cast("bigint") for name in PER_RUN})
        own = self.runs.select("run_id", *[F.col(name).cast("bigint").alias(f"_{name}") for name in PER_RUN])
        return records.join(own, "run_id")


# --- records ------------------------------------------------------------------

def accepted_records(logs: DataFrame, order: str = "arrival") -> DataFrame:
    """Records with a loss, one per step: the first to arrive.

    ``order`` is the column that tells arrival.  Grouping by run and step
    combines on the map side and spreads a long run.
    """
    kept = [c for c in logs.columns if c not in ("run_id", "step")]
    first = F.min_by(F.struct(*kept), order).alias("_first")
    return logs.filter(F.col("loss").isNotNull()).groupBy("run_id", "step").agg(first).select(
        "run_id", "step", "_first.*"
    )


def numbered_records(records: DataFrame) -> DataFrame:
    """Add ``n``, the number of the record in its run, by step."""
    return number_in_group(records, "run_id", ["step"], [F.floor(F.col("step") / 1024)])


def event_log(events: DataFrame) -> DataFrame:
    """An event table as a training log: a run per user, events as its steps.

    Blocks are seconds within hours, so the events of a busy hour are numbered
    in many tasks.
    """
    log = events.select(
        F.col("user_id").alias("run_id"), "ts", F.col("event_id").alias("arrival"), F.col("value").alias("loss"))
    blocks = [F.date_trunc("hour", "ts"), F.date_trunc("second", "ts")]
    return number_in_group(log, "run_id", ["ts", "arrival"], blocks, "step").select(
        "run_id", "step", "arrival", "loss", F.lit(None).cast("double").alias("lr")
    )


# --- the trace ----------------------------------------------------------------

def _is_wild(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == float("inf"))


def _marked(df: DataFrame, mark: str) -> Column:
    return F.coalesce(F.col(mark), F.lit(False)) if mark in df.columns else F.lit(False)


def _lr_counts(earlier: Column) -> Column:
    """The learning rate where it counts towards the highest one seen."""
    return F.when(earlier, F.col("lr")).when(F.col("_warm") & F.col("_exposed") & ~F.isnan("lr"), F.col("lr"))


def smoothed(numbered: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Add ``ema``, the gates and the settings of the run.

    The moving average is linear, so the values of a block are its own
    weighted sums plus a share of one carried value.  A row marked ``EARLIER``
    stands for all records of its run up to its ``n``: its loss is their
    average, its learning rate the highest one.
    """
    s, earlier = settings, _marked(numbered, EARLIER)
    size, beta = s.smooth_rows, s.beta
    block, at = F.floor((F.col("n") - 1) / size), (F.col("n") - 1) % size
    share = F.when((F.col("n") == 1) | earlier, F.lit(1.0)).otherwise(F.lit(1.0 - beta))
    exposed = F.greatest(F.col("step"), F.lit(0)) / F.greatest("_steps_total", F.lit(1)) >= s.exposure_floor
    rows = s.on(numbered).withColumns({
        "_block": block, "_at": at, "_warm": F.col("step") >= F.col("_warmup"), "_exposed": exposed,
        "_x": F.when(_is_wild(F.col("loss")), F.lit(0.0)).otherwise(share * F.col("loss")),
        "_wild": F.when(_is_wild(F.col("loss")), F.col("loss")),
    }).withColumn("_lr", _lr_counts(earlier))
    sums = rows.groupBy("run_id", "_block").agg(
        F.sum(F.col("_x") * F.pow(F.lit(beta), F.lit(size - 1) - F.col("_at"))).alias("_end"),
        F.sum("_wild").alias("_wild_all"), F.max("_lr").alias("_top"),
    )
    # Ends further back than this have no weight left in a double.
    reach = max(1, math.ceil(320 / (size * -math.log10(beta))))
    by_block = Window.partitionBy("run_id").orderBy("_block")
    near, before = by_block.rowsBetween(-reach, -1), by_block.rowsBetween(Window.unboundedPreceding, -1)
    ended = F.aggregate(
        F.collect_list("_end").over(near), F.lit(0.0), lambda acc, x: acc * F.lit(beta ** size) + x
    )
    carry = sums.select(
        "run_id", "_block", ended.alias("_carry"), F.sum("_wild_all").over(before).alias("_carry_wild"),
        F.max("_top").over(before).alias("_carry_top"))
    so_far = Window.partitionBy("run_id", "_block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    local = F.sum(F.col("_x") * F.pow(F.lit(beta), -F.col("_at"))).over(so_far)
    settled = F.col("_carry") * F.pow(F.lit(beta), F.col("_at") + 1) + local * F.pow(F.lit(beta), F.col("_at"))
    broken = F.coalesce(F.sum("_wild").over(so_far) + F.col("_carry_wild"), F.sum("_wild").over(so_far), "_carry_wild")
    top = F.greatest(F.max("_lr").over(so_far), F.col("_carry_top"), F.lit(0.0))
    lr_ok = F.lit(True)
    if s.lr_fraction < 1.0:
        lr_ok = F.coalesce(F.col("lr") <= F.col("_top_lr") * s.lr_fraction + 1e-12, F.lit(True))
    return rows.join(carry, ["run_id", "_block"]).withColumns({
        "ema": F.coalesce(settled + broken, settled), "_top_lr": top,
    }).select(
        *numbered.columns, "ema", F.col("_warm").alias("warm"), F.col("_exposed").alias("exposed"),
        lr_ok.alias("lr_ok"), (F.col("n") >= F.col("_history")).alias("enough"), "_window", "_slope_window")


def ema_series(numbered: DataFrame, settings: MonitorSettings) -> DataFrame:
    """The smoothed loss of every record."""
    return smoothed(numbered, settings).select(*numbered.columns, "ema")


def ema_final(numbered: DataFrame, settings: MonitorSettings) -> DataFrame:
    """The last smoothed loss of every run."""
    return ema_series(numbered, settings).groupBy("run_id").agg(
        F.max("n").alias("n"), F.max_by("ema", "n").alias("ema")
    )


def gate_flags(numbered: DataFrame, settings: MonitorSettings) -> DataFrame:
    """The gates ``warm``, ``exposed``, ``lr_ok`` and ``enough`` of every record."""
    return smoothed(numbered, settings).select("run_id", "n", "warm", "exposed", "lr_ok", "enough")


def window_blocks(smooth: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Records in blocks of a run, with the last ``lookback`` records of the block before.

    ``_borrowed`` marks those copies, which the windows of a block look back at,
    and rows marked ``TAIL``, which come from before the records at hand.
    """
    size = settings.window_rows
    own, at = F.floor((F.col("n") - 1) / size), (F.col("n") - 1) % size
    copies = F.when(at >= size - settings.lookback, F.array(own, own + 1)).otherwise(F.array(own))
    return smooth.withColumn("block", F.explode(copies)).withColumn(
        "_borrowed", (F.col("block") != own) | _marked(smooth, TAIL))


def window_stats(rows: dict, s: MonitorSettings, sigma: bool = True, slope: bool = True) -> dict:
    """Spread and slope of a block's own rows; those that are not asked for are left out."""
    fresh = int((~rows["_borrowed"].astype(bool)).sum())
    known, made = rows["ema"].astype(float), {}
    with np.errstate(invalid="ignore"):
        if sigma:
            made["sigma"] = np.maximum(sigma_of_last(known, fresh, int(rows["_window"][0])), s.sigma_floor)
        if slope:
            made["slope"] = slope_of_last(known, fresh, int(rows["_slope_window"][0]))
    return made


def with_windows(smooth: DataFrame, settings: MonitorSettings, sigma: bool = True, slope: bool = True) -> DataFrame:
    """Add the robust ``sigma`` and the ``slope`` over the last values to smoothed records.

    A median per window is far cheaper over numpy windows of a whole block
    than over an array per row, so it is computed on Arrow batches.  The slope
    alone comes from running sums, if all runs have the same window.
    """
    if slope and not sigma and settings.runs is None:
        return with_slope(smooth, settings)
    s = replace(settings, runs=None)  # goes to the tasks
    kept = [c for c in smooth.columns if c not in ("lr", "_window", "_slope_window")]
    kinds = dict(smooth.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in kept] + [
        f"{name} double" for name, wanted in (("sigma", sigma), ("slope", slope)) if wanted])

    def work(rows):
        own = ~rows["_borrowed"].astype(bool)
        return {**{c: rows[c][own] for c in kept}, **window_stats(rows, s, sigma, slope)}
    blocks = window_blocks(smooth.drop("lr"), s)
    return map_groups(blocks, ["run_id", "block"], "n", work, schema)


def with_slope(smooth: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Add the least-squares ``slope`` over the last values: 0 below eight of them.

    Inside a block, sums of the values and of the values times their place run
    along; a window is the difference of two of them.  Values are taken from
    the first of the block and places from its middle, so a large offset does
    not eat up the digits.
    """
    size, s = settings.slope_window, replace(settings, window=1)
    kept = [c for c in smooth.columns if c not in ("lr", "_window", "_slope_window")]
    line = Window.partitionBy("run_id", "block").orderBy("n")
    so_far, sound = line.rowsBetween(Window.unboundedPreceding, 0), ~_is_wild(F.col("ema"))
    rows = window_blocks(smooth.drop("lr"), s).withColumns({
        "_place": F.row_number().over(line) - s.window_rows / 2,
        "_centred": F.when(sound, F.col("ema") - F.coalesce(F.first("ema").over(so_far), F.lit(0.0))).otherwise(0.0)})
    sums = rows.withColumns({
        "_sum": F.sum("_centred").over(so_far), "_moment": F.sum(F.col("_centred") * F.col("_place")).over(so_far),
        "_wild": F.sum(F.when(sound, 0).otherwise(1)).over(so_far)})
    windows = sums.withColumns({
        f"{name}_in": F.col(name) - F.coalesce(F.lag(name, size).over(line), F.lit(0)) for name in ("_sum", "_moment", "_wild")})
    count = F.least(F.col("n"), F.lit(size)).cast("double")
    middle = F.col("_place") - (count - 1) / 2
    fitted = (F.col("_moment_in") - middle * F.col("_sum_in")) / (count * (count * count - 1) / 12)
    # An average that went wild stays so: NaN, or the same infinity from some place of the window on.
    wild = F.when((F.isnan("ema") | sound) | (count - F.col("_wild_in") <= (count - 1) / 2), float("nan")).otherwise(F.col("ema"))
    slope = F.when(count < 8, 0.0).when(F.col("_wild_in") > 0, wild).otherwise(fitted)
    return windows.filter(~F.col("_borrowed")).select(*kept, slope.alias("slope"))


def monitor_trace(numbered: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Everything about a record but its decision: average, best, spread, slope and gates."""
    return with_windows(best_so_far(smoothed(numbered, settings), settings), settings)


# --- best so far --------------------------------------------------------------

def best_so_far(smooth: DataFrame, settings: MonitorSettings, held: DataFrame | None = None) -> DataFrame:
    """Add ``best_ema``, ``since_best`` and the ``cooldown`` that follows a best.

    A record is a new best when it is lower than all before it by a margin.
    Blocks pass on their lowest value, and then their last best.  ``held`` has
    ``run_id, low, best, best_n`` of the records that rows marked ``EARLIER``
    stand for.
    """
    size = settings.block_rows
    finite = F.when(~_is_wild(F.col("ema")), F.col("ema"))
    blocks = smooth.withColumn("_block", F.floor((F.col("n") - 1) / size))
    earlier = Window.partitionBy("run_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("run_id", "_block").orderBy("n")
    lows = blocks.groupBy("run_id", "_block").agg(F.min(finite).alias("_low")).select(
        "run_id", "_block", F.min("_low").over(earlier).alias("_low"))
    low = F.least("_low", "_low_before", F.min(finite).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    fresh = finite.isNotNull() & ~_marked(smooth, EARLIER) & F.coalesce(finite < low - fv.BEST_MARGIN, F.lit(True))
    known = blocks.join(lows, ["run_id", "_block"])
    if held is None:
        known = known.withColumns({
            "_low_before": F.lit(None).cast("double"), "_best_before": F.lit(None).cast("struct<n:bigint,ema:double>")})
    else:
        known = known.join(held.select(
            "run_id", F.col("low").alias("_low_before"), F.when(F.col("best_n") > 0, F.struct(
                F.col("best_n").alias("n"), F.col("best").alias("ema"))).alias("_best_before")), "run_id", "left")
    marked = known.withColumn("_best", F.when(fresh, F.struct("n", "ema")))
    carried = marked.groupBy("run_id", "_block").agg(F.max("_best").alias("_carried")).select(
        "run_id", "_block", F.max("_carried").over(earlier).alias("_carried"))
    best = F.greatest("_carried", "_best_before", F.max("_best").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.col("n") - F.coalesce(F.col("_held.n"), F.lit(0))
    return marked.join(carried, ["run_id", "_block"]).withColumn("_held", best).select(
        *smooth.columns, F.coalesce("_held.ema", F.lit(float("inf"))).alias("best_ema"), since.alias("since_best"),
        F.when(F.col("_held").isNull(), 0).otherwise(
            F.greatest(F.lit(settings.cooldown) - since, F.lit(0))).alias("cooldown"))


def best_in_block(ema: np.ndarray, n: np.ndarray, best: float, best_n: int, lowest: float):
    """Best value and records since it, for consecutive records after a best and a lowest value."""
    values = np.where(np.isfinite(ema), ema, np.inf)
    low = np.minimum.accumulate(np.concatenate(([lowest], values)))[:-1]
    with np.errstate(invalid="ignore"):
        fresh = np.isfinite(values) & ((values < low - fv.BEST_MARGIN) | np.isinf(low))
    which = np.maximum.accumulate(np.where(fresh, np.arange(1, len(ema) + 1), 0))
    return np.concatenate(([best], ema))[which], n - np.concatenate(([best_n], n))[which]


def trend_flags(followed: DataFrame, settings: MonitorSettings) -> DataFrame:
    """Add ``worsening`` and ``plateau`` to a trace with ``since_best``."""
    s = settings
    sound = ~_is_wild(F.col("ema"))
    calm = F.col("sigma") <= max(0.5 * s.sigma_floor, 0.05)
    flat = F.abs("slope") <= s.slope_threshold
    return followed.withColumns({
        "worsening": sound & (F.col("slope") >= s.slope_threshold),
        "plateau": sound & (F.col("since_best") >= s.patience) & flat & calm,
    })


# --- the decision -------------------------------------------------------------

def decision_items(s: MonitorSettings, n, ema, sigma, slope, since, warm, exposed, lr_ok, enough):
    """Levels and flags of the improvement chain for consecutive records.

    The reference value moves without a test at the first record and while
    the warm-up, exposure or history gate is shut; a shut learning-rate gate
    leaves it alone.
    """
    sound = np.isfinite(ema)
    tested = warm & exposed & lr_ok & enough
    with np.errstate(invalid="ignore"):
        level = ema + np.minimum(s.min_drop, s.min_sigmas * (sigma + 1e-12))
        calm = sigma <= max(0.5 * s.sigma_floor, 0.05)
        plateau = (since >= s.patience) & (np.abs(slope) <= s.slope_threshold) & calm
        flagged = tested & sound & (plateau | (slope >= s.slope_threshold))
    level = np.where(tested & sound, level, rc.NEVER)
    shut = ~warm | ~exposed | (lr_ok & ~enough)
    level = np.where(shut | (n == 1), rc.ALWAYS, level)
    return level, flagged


def incoming_range(rows: dict, s: MonitorSettings) -> tuple[float, float]:
    """Bounds of the reference value with which a block begins.

    It is an earlier average, so not below their lowest.  If the record before
    could move it, it either did or failed to, and then the reference is less
    than the largest drop above that record.
    """
    before = np.flatnonzero(rows["_borrowed"].astype(bool))
    if not len(before):
        return -np.inf, np.inf
    last = before[-1]
    ema, best = float(rows["ema"][last]), float(rows["best_ema"][last])
    slack = 1e-9 * (1 + abs(ema))
    known = np.isfinite(ema) and bool(rows["lr_ok"][last])
    return best - slack, ema + s.min_drop + slack if known else np.inf


def block_summaries(followed: DataFrame, settings: MonitorSettings) -> DataFrame:
    """What each block of a run does to the reference value, by the chain of its records."""
    s = replace(settings, runs=None)  # goes to the tasks

    def block_summary(rows):
        own = ~rows["_borrowed"].astype(bool)
        if not own.any():
            return {name: [] for name in ("run_id", "block", *rc.FIELDS, "tail_end")}
        low, high = incoming_range(rows, s)
        stats = window_stats(rows, s)
        rows = {name: values[own] for name, values in rows.items()}
        gates = [rows[gate].astype(bool) for gate in ("warm", "exposed", "lr_ok", "enough")]
        ema, n = rows["ema"].astype(float), rows["n"]
        level, flagged = decision_items(s, n, ema, stats["sigma"], stats["slope"], rows["since_best"], *gates)
        summary = rc.summarise(level, ema, flagged, n, rows["step"], low, high)
        return summary_row(summary, run_id=rows["run_id"][0], block=rows["block"][0])

    blocks = window_blocks(followed.drop("loss", "lr", "arrival", "cooldown", EARLIER), s).drop(TAIL)
    return map_groups(blocks, ["run_id", "block"], "n", block_summary, f"{KEYS}, {rc.SUMMARY}")


def stop_decisions(logs: DataFrame, settings: MonitorSettings) -> DataFrame:
    """The first stop of every run that stops: ``run_id, stop_step, reason``.

    ``logs`` has ``run_id, step, arrival, loss, lr``.  Of the records of a step
    the first to arrive counts, null losses are no records.  The hard cap
    needs no loss and comes first, so records from the cap on are never looked
    at.  Without a table of runs, every run has the same settings; with one,
    runs that are not in it are left out.
    """
    s = settings
    capped = hard_cap_stops(logs, s)
    if s.runs is None:
        before = logs if s.hard_cap_step is None else logs.filter(F.col("step") < s.hard_cap_step)
    else:
        caps = s.runs.select("run_id", F.col("hard_cap_step").alias("_cap"))
        before = logs.join(caps, "run_id").filter(F.coalesce(F.col("step") < F.col("_cap"), F.lit(True))).drop("_cap")

    numbered = numbered_records(accepted_records(before))
    summaries = block_summaries(best_so_far(smoothed(numbered, settings), s), s)
    stopped = chain_ends(summaries, float("inf")).select(
        "run_id", F.col("end_mark").alias("stop_step"), F.lit("trend").alias("reason")
    )
    return stopped.unionByName(capped).groupBy("run_id").agg(
        F.min("stop_step").alias("stop_step"), F.min_by("reason", "stop_step").alias("reason")
    )


def hard_cap_stops(logs: DataFrame, settings: MonitorSettings) -> DataFrame:
    """The first record of each run at or past its hard cap, loss or not."""
    if settings.runs is None:
        cap = F.lit(False) if settings.hard_cap_step is None else F.col("step") >= settings.hard_cap_step
        reached = logs.filter(cap)
    else:
        caps = settings.runs.select("run_id", F.col("hard_cap_step").alias("_cap"))
        reached = logs.join(caps, "run_id").filter(F.col("step") >= F.col("_cap"))
    return reached.groupBy("run_id").agg(
        F.min("step").cast("bigint").alias("stop_step"), F.lit("hard_cap").alias("reason")
    )


def periodic_summary(flagged: DataFrame, every: int) -> DataFrame:
    """One line of the trace every ``every`` steps, once all gates are open."""
    open_gates = F.col("warm") & F.col("exposed") & F.col("lr_ok") & F.col("enough")
    return flagged.filter(open_gates & (F.col("step") % every == 0)).select(
        "run_id", "step", "ema", "best_ema", "sigma", "slope", "since_best", "plateau", "worsening"
    )
