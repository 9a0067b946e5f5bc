"""The stop decision over a live stream of log records.

Each micro-batch is one distributed job over its records and the state of
their runs.  A run with few new records is advanced record by record in one
task.  A run with many is cut into blocks, as in the batch operators: the
blocks are smoothed, searched for a best and summarised apart, and the run's
state takes only the summaries, in order.

State lives in tables beside the stream's checkpoint, one version for each
micro-batch, with the runs that it touched; every ``SNAPSHOT_EVERY`` of them
become one snapshot.  A micro-batch reads versions before its own number and
overwrites its own, so a repeated one gives the same.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import reset_chain as rc
from corpusloom.functions.windows import sigma_of_last, slope_of_last
from corpusloom.operators.chains import chain_values, map_groups
from corpusloom.operators.monitor import (
    EARLIER, PER_RUN, TAIL, MonitorSettings, accepted_records, best_in_block, best_so_far, block_summaries, decision_items,
    hard_cap_stops, numbered_records, smoothed,
)
from corpusloom.session import delete_folder, list_folder, stage_table

LOG = "run_id bigint, step bigint, arrival bigint, loss double, lr double"
STOP = "run_id bigint, stop_step bigint, reason string"
STATE = (
    "n bigint, last_step bigint, ema double, reference double, best double, best_n bigint, "
    "top_lr double, stopped boolean, tail array<double>, low double"
)
START = (0, -1, None, float("inf"), float("inf"), 0, 0.0, False, [], float("inf"))
# A run's row: its state, the highest step seen, records that came too late, and the stop of this micro-batch.
RUN = f"run_id bigint, {STATE}, top_step bigint, late bigint, seen bigint, stop_step bigint, reason string"
SNAPSHOT_EVERY = 16
BYTES_PER_BATCH = 128 << 20
HOT_ROWS = 100_000        # records of one run in a micro-batch from which it is cut into blocks


def moving_average(losses: np.ndarray, ema: float | None, s: MonitorSettings) -> np.ndarray:
    """The average after each loss, in stretches within floating-point range."""
    series, size = np.empty(len(losses)), s.smooth_rows
    with np.errstate(invalid="ignore", over="ignore"):
        for at in range(0, len(losses), size):
            part = (1 - s.beta) * losses[at: at + size]
            if ema is None:
                part[0], ema = losses[0], 0.0
            power = s.beta ** np.arange(len(part) + 1)
            series[at: at + size] = power[1:] * ema + power[:-1] * np.cumsum(part / power[:-1])
            ema = series[at + len(part) - 1]
    return series


def advance(s: MonitorSettings, state: tuple, records):
    """State after the records, and the stop (step, reason) they lead to or None.

    ``records`` holds arrays ``step, arrival, loss, lr, loss_seen, lr_seen``,
    in any order; of one step the first to arrive counts, and steps at or
    before the last one seen are dropped.  The state keeps no more smoothed
    values than the longest window needs.
    """
    n, last_step, ema, reference, best, best_n, top_lr, stopped, tail, low = state
    cap = np.inf if s.hard_cap_step is None else s.hard_cap_step
    step, arrival, loss, lr, seen, given = (
        np.asarray(records[c]) for c in ("step", "arrival", "loss", "lr", "loss_seen", "lr_seen"))
    capped = step[step >= cap]
    stop = (int(capped.min()), "hard_cap") if len(capped) else None
    kept = np.flatnonzero(seen.astype(bool) & (step > last_step) & (step < cap))
    kept = kept[np.lexsort((arrival[kept], step[kept]))]
    kept = kept[np.append(True, np.diff(step[kept]) > 0)[: len(kept)]]
    if len(kept):
        step, lr, given = step[kept], lr[kept].astype(float), given[kept].astype(bool)
        series = moving_average(loss[kept].astype(float), ema, s)
        ema = series[-1]
        number = n + 1 + np.arange(len(series))
        known = np.concatenate((np.asarray(tail, dtype=float), series))
        with np.errstate(invalid="ignore"):
            sigma = np.maximum(sigma_of_last(known, len(series), s.window), s.sigma_floor)
            slope = slope_of_last(known, len(series), s.slope_window)
        best_values, since = best_in_block(series, number, best, best_n, low)
        warm, exposed = step >= s.warmup, np.maximum(step, 0) / s.steps_total >= s.exposure_floor
        counted = np.where(warm & exposed & ~np.isnan(lr), lr, -np.inf)
        tops = np.maximum.accumulate(np.concatenate(([top_lr], counted)))[1:]
        lr_ok = ~given | (lr <= tops * s.lr_fraction + 1e-12) | (s.lr_fraction >= 1)
        level, flagged = decision_items(
            s, number, series, sigma, slope, since, warm, exposed, lr_ok, number >= s.history
        )
        fired, end = rc.follow(level, series, flagged, reference)
        if end is not None:
            stop = (int(step[end]), "trend")
        reference = series[fired[-1]] if fired else reference
        n, last_step, top_lr = int(number[-1]), int(step[-1]), float(tops[-1])
        best, best_n = float(best_values[-1]), int(number[-1] - since[-1])
        low = float(min(low, np.min(series[np.isfinite(series)], initial=np.inf)))
        tail = known[max(0, len(known) - s.lookback):].tolist()
    ema = None if ema is None else float(ema)
    after = (n, last_step, ema, float(reference), best, best_n, top_lr, stopped or stop is not None, tail, low)
    return after, stop


class RunTables:
    """The versions of the runs' state and of the records that wait, below one folder."""

    def __init__(self, spark: SparkSession, folder: str, keep_days: float = 7.0):
        self.spark, self.folder, self.keep_days = spark, folder, keep_days

    def path(self, kind: str, batch: int) -> str:
        return f"{self.folder}/{kind}/batch={batch}"

    def before(self, batch: int) -> DataFrame:
        """The latest row of every run as of the start of a micro-batch."""
        base = batch - batch % SNAPSHOT_EVERY
        paths = [self.path("snapshot", base)] if base else []
        paths += [self.path("state", b) for b in range(base, batch)]
        if not paths:
            return self.spark.createDataFrame([], RUN)
        names = [f.split()[0] for f in RUN.split(", ")]
        rows = self.spark.read.schema(f"{RUN}, version int").parquet(*paths)
        latest = rows.groupBy("run_id").agg(F.max_by(F.struct(*names[1:]), "version").alias("r"))
        return latest.select("run_id", "r.*")

    def snapshot(self, batch: int) -> None:
        """Put the versions before a multiple of ``SNAPSHOT_EVERY`` together; those that two snapshots cover go.

        Runs without a record for ``keep_days`` are forgotten, stopped or not.
        """
        if batch == 0 or batch % SNAPSHOT_EVERY:
            return
        base = batch - SNAPSHOT_EVERY
        paths = ([self.path("snapshot", base)] if base else []) + [self.path("state", b) for b in range(base, batch)]
        names = [f.split()[0] for f in RUN.split(", ")]
        rows = self.spark.read.schema(f"{RUN}, version int").parquet(*paths)
        latest = rows.groupBy("run_id").agg(F.max_by(F.struct(*names[1:]), "version").alias("r")).select("run_id", "r.*")
        young = F.col("seen") >= F.unix_timestamp() - int(self.keep_days * 86_400)
        latest.filter(young).withColumn("version", F.lit(batch - 1)).write.mode("overwrite").parquet(self.path("snapshot", batch))
        for old in range(max(0, base - SNAPSHOT_EVERY), base):
            for kind in ("state", "waiting", "snapshot"):
                delete_folder(self.spark, self.path(kind, old))

    def waiting(self, batch: int) -> DataFrame | None:
        """The records that the micro-batch before left for later."""
        if batch == 0 or f"batch={batch - 1}" not in list_folder(self.spark, f"{self.folder}/waiting"):
            return None
        return self.spark.read.schema(LOG).parquet(self.path("waiting", batch - 1))


def _held_runs(records: DataFrame, known: DataFrame, settings: MonitorSettings) -> DataFrame:
    """A row for each run that has records and settings: its state, ``n_rows`` and the highest step so far."""
    touched = records.groupBy("run_id").agg(F.count("*").alias("n_rows"), F.max("step").alias("_top"))
    names = [f.split()[0] for f in STATE.split(", ")]
    kinds = dict(known.dtypes)
    fresh = {name: F.lit(value).cast(kinds[name]) if name != "tail" else F.array().cast("array<double>")
             for name, value in zip(names, START)}
    joined = settings.on(touched).join(known, "run_id", "left")
    unknown = F.col("n").isNull()
    return joined.select(
        "run_id", "n_rows", *[F.when(unknown, fresh[name]).otherwise(F.col(name)).alias(name) for name in names],
        F.greatest("top_step", "_top").alias("top_step"), F.coalesce("late", F.lit(0)).cast("bigint").alias("late"),
        *[f"_{name}" for name in PER_RUN])


NO_CAP = -1


def _advanced(records: DataFrame, held: DataFrame, settings: MonitorSettings) -> DataFrame:
    """New rows of runs whose records fit into one task; many runs share an Arrow batch.

    The state of a run comes as a row before its records.
    """
    plain = replace(settings, runs=None)
    names = [f.split()[0] for f in STATE.split(", ")]
    carried = [*names, "top_step", "late", *[f"_{name}" for name in PER_RUN]]
    fields = [f.split()[0] for f in RUN.split(", ")]
    arrays = ("step", "arrival", "loss", "lr", "loss_seen", "lr_seen")

    def work(rows: dict) -> dict:
        if rows["_kind"][0]:  # a run without settings
            return {name: [] for name in fields}
        row = {name: rows[name][0] for name in carried}
        state = tuple(row[name] for name in names)
        if state[0] == 0:
            state = (*state[:2], None, *state[3:])
        late, stop = int((rows["step"][1:] <= state[1]).sum()), None
        if not state[7] and len(rows["step"]) > 1:
            own = {name: int(row[f"_{name}"]) for name in PER_RUN}
            own["hard_cap_step"] = None if own["hard_cap_step"] == NO_CAP else own["hard_cap_step"]
            state, stop = advance(replace(plain, **own), state, {name: rows[name][1:] for name in arrays})
            state = state if stop is None else (*state[:8], [], state[9])
        made = dict(zip(names, state)) | {
            "run_id": rows["run_id"][0], "top_step": row["top_step"], "late": row["late"] + late, "seen": None,
            "stop_step": stop and stop[0], "reason": stop and stop[1]}
        return {name: [made[name]] for name in fields}

    # Nothing is null here: pandas has one missing value for null and NaN, which mean different things.
    kinds = dict(held.dtypes)
    nothing = {"array<double>": F.array().cast("array<double>"), "boolean": F.lit(False)}
    blank = {c: nothing.get(kinds[c], F.lit(0)).cast(kinds[c]).alias(c) for c in carried}
    ours = records.select(
        "run_id", F.lit(1).alias("_kind"), "step", F.coalesce("arrival", F.lit(0)).alias("arrival"),
        F.coalesce("loss", F.lit(0.0)).alias("loss"), F.coalesce("lr", F.lit(0.0)).alias("lr"),
        F.col("loss").isNotNull().alias("loss_seen"), F.col("lr").isNotNull().alias("lr_seen"), *blank.values())
    first = held.withColumns({"_hard_cap_step": F.coalesce("_hard_cap_step", F.lit(NO_CAP)), "ema": F.coalesce("ema", F.lit(0.0))})
    begin = first.select(
        "run_id", F.lit(0).alias("_kind"), F.lit(-1).cast("bigint").alias("step"), F.lit(-1).cast("bigint").alias("arrival"),
        F.lit(0.0).alias("loss"), F.lit(0.0).alias("lr"), F.lit(False).alias("loss_seen"), F.lit(False).alias("lr_seen"), *carried)
    return map_groups(begin.unionByName(ours), ["run_id"], "_kind", work, RUN)


def _by_blocks(records: DataFrame, held: DataFrame, settings: MonitorSettings) -> DataFrame:
    """New rows of runs with many records: the work is dealt by blocks, and a run's state takes their summaries."""
    s = replace(settings, runs=held.select("run_id", *[F.col(f"_{name}").alias(name) for name in PER_RUN]))
    live = held.filter(~F.col("stopped"))
    placed = records.join(live.select("run_id", "last_step", F.col("n").alias("_n"), F.col("_hard_cap_step").alias("_cap")), "run_id")
    late = placed.filter("step <= last_step").groupBy("run_id").agg(F.count("*").alias("_late"))
    capped = hard_cap_stops(placed.select("run_id", "step"), s)
    before = placed.filter("step > last_step AND (_cap IS NULL OR step < _cap)")
    numbered = numbered_records(accepted_records(before.select("run_id", "step", "arrival", "loss", "lr"))).join(
        live.select("run_id", F.col("n").alias("_n")), "run_id").withColumn("n", F.col("n") + F.col("_n")).drop("_n")
    begun = live.filter("n > 0")
    earlier = begun.select(
        "run_id", F.col("last_step").alias("step"), F.lit(None).cast("bigint").alias("arrival"), F.col("ema").alias("loss"),
        F.col("top_lr").alias("lr"), "n", F.lit(True).alias(EARLIER))
    joined = numbered.withColumn(EARLIER, F.lit(False)).unionByName(earlier)
    followed = stage_table(
        best_so_far(smoothed(joined, s), s, live).filter(~F.col(EARLIER)).drop(EARLIER), "followed")
    tails = begun.select(
        "run_id", "n", "low", F.size("tail").alias("_size"), F.posexplode("tail").alias("_at", "ema"),
        F.col("_window"), F.col("_slope_window")).select(
        "run_id", F.lit(None).cast("bigint").alias("step"), (F.col("n") - F.col("_size") + F.col("_at") + 1).alias("n"), "ema",
        F.lit(False).alias("warm"), F.lit(False).alias("exposed"), F.lit(False).alias("lr_ok"), F.lit(False).alias("enough"),
        "_window", "_slope_window", F.col("low").alias("best_ema"), F.lit(0).cast("bigint").alias("since_best"),
        F.lit(True).alias(TAIL))
    steps = followed.drop("arrival", "loss", "lr", "cooldown").withColumn(TAIL, F.lit(False))
    tails = tails.select(*[F.col(name).cast(kind).alias(name) for name, kind in steps.dtypes])
    summaries = block_summaries(steps.unionByName(tails), s)
    walked = chain_values(summaries, live.select("run_id", F.col("reference").alias("value")))

    finite = F.when(~(F.isnan("ema") | (F.abs("ema") == float("inf"))), F.col("ema"))
    counted = F.when(F.col("warm") & F.col("exposed") & ~F.isnan("lr"), F.col("lr"))
    last = followed.groupBy("run_id").agg(
        F.max(F.struct("n", "step", "ema", "best_ema", "since_best")).alias("z"), F.min(finite).alias("_low"),
        F.max(counted).alias("_top_lr"))
    ends = followed.join(last.select("run_id", F.col("z.n").alias("_last")), "run_id").filter(
        F.col("n") > F.col("_last") - s.lookback)
    fresh_tail = ends.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("n", "ema"))).alias("_ends"))
    stops = walked.filter("end_mark >= 0").select(
        "run_id", F.col("end_mark").alias("stop_step"), F.lit("trend").alias("reason")).unionByName(capped)
    first = stops.groupBy("run_id").agg(F.min(F.struct("stop_step", "reason")).alias("stop"))
    whole = held
    for part in (last, walked, fresh_tail, first, late):
        whole = whole.join(part, "run_id", "left")
    moved = F.col("z").isNotNull()
    stopped = F.col("stopped") | F.col("stop").isNotNull()
    tail = F.concat("tail", F.coalesce(F.transform("_ends", lambda e: e["ema"]), F.array().cast("array<double>")))
    keep = F.greatest(F.size(tail) - s.lookback, F.lit(0)) + 1

    def after(new: Column | str, old: str) -> Column:
        return F.when(moved, F.col(new) if isinstance(new, str) else new).otherwise(F.col(old)).alias(old)
    return whole.select(
        "run_id", after("z.n", "n"), after("z.step", "last_step"), after("z.ema", "ema"),
        F.coalesce("value", "reference").alias("reference"), after("z.best_ema", "best"),
        after(F.col("z.n") - F.col("z.since_best"), "best_n"), F.greatest("top_lr", "_top_lr").alias("top_lr"),
        stopped.alias("stopped"),
        F.when(stopped, F.array().cast("array<double>")).otherwise(F.slice(tail, keep, s.lookback)).alias("tail"),
        F.least("low", "_low").alias("low"), "top_step", (F.col("late") + F.coalesce("_late", F.lit(0))).alias("late"),
        F.lit(None).cast("bigint").alias("seen"), F.col("stop.stop_step").alias("stop_step"), F.col("stop.reason").alias("reason"))


def _rest(records: DataFrame, stopped: DataFrame) -> DataFrame:
    """New rows of runs that have stopped: their records are counted, and not looked at."""
    placed = records.join(stopped.select("run_id", "last_step"), "run_id")
    late = placed.filter("step <= last_step").groupBy("run_id").agg(F.count("*").alias("_late"))
    made = {
        "late": F.col("late") + F.coalesce("_late", F.lit(0)), "seen": F.lit(None).cast("bigint"),
        "stop_step": F.lit(None).cast("bigint"), "reason": F.lit(None).cast("string")}
    return stopped.join(late, "run_id", "left").withColumns(made).select(*[f.split()[0] for f in RUN.split(", ")])


def next_rows(
    records: DataFrame, known: DataFrame, settings: MonitorSettings, delay: int = 0, close: bool = False, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """The rows of the runs after some records, and the records that wait for later.

    ``records`` are those of a micro-batch and those that waited.  A record
    waits until its run has one that is ``delay`` steps further on; so records
    that are no more than that out of order are handled in order.  ``close``
    lets nothing wait.
    """
    held, waiting = _held_runs(records, known, settings), None
    many = records.count() > hot_rows  # else no run can have so many
    if many or (delay and not close):
        held = stage_table(held, "held")
    if delay and not close:
        tops = held.select("run_id", "top_step", "last_step", "stopped")
        placed = records.join(tops, "run_id")
        ready = F.col("stopped") | (F.col("step") <= F.greatest(F.col("top_step") - delay, F.col("last_step")))
        columns = [f.split()[0] for f in LOG.split(", ")]
        waiting = placed.filter(~ready).select(*columns)
        records = placed.filter(ready).select(*columns)
    if not many:
        return _advanced(records, held, settings), waiting
    live = held.filter(~F.col("stopped"))
    # No more than the records of a micro-batch over ``hot_rows``.
    hot = [r["run_id"] for r in live.filter(F.col("n_rows") > hot_rows).select("run_id").collect()]
    is_hot = F.coalesce(F.col("run_id").isin(hot), F.lit(False))
    # Runs that have stopped or have no settings may have any number of records.
    few = records.filter(~is_hot).join(live.select("run_id"), "run_id", "left_semi")
    made = _advanced(few, live.filter(~is_hot), settings).unionByName(_rest(records, held.filter("stopped")))
    if hot:
        made = made.unionByName(_by_blocks(records.filter(is_hot), live.filter(is_hot), settings))
    return made, waiting


def micro_batch(
    records: DataFrame, batch: int, tables: RunTables, sink: str, settings: MonitorSettings, delay: int = 0,
    hot_rows: int = HOT_ROWS,
) -> None:
    """Handle the records of one micro-batch; writing its state, waiting records and stops again changes nothing.

    A record without a run or a step is none.
    """
    tables.snapshot(batch)
    columns = [f.split()[0] for f in LOG.split(", ")]
    rows, waited = records.select(*columns).dropna(subset=["run_id", "step"]), tables.waiting(batch)
    rows = rows if waited is None else rows.unionByName(waited)
    made, waiting = next_rows(rows, tables.before(batch), settings, delay, hot_rows=hot_rows)
    if waiting is not None:
        waiting.write.mode("overwrite").parquet(tables.path("waiting", batch))
    made.withColumns({"seen": F.unix_timestamp(), "version": F.lit(batch)}).write.mode("overwrite").parquet(
        tables.path("state", batch))
    written = tables.spark.read.schema(RUN).parquet(tables.path("state", batch))
    written.filter("stop_step IS NOT NULL").select("run_id", "stop_step", "reason").coalesce(1).write.mode("overwrite").parquet(
        f"{sink}/batch={batch}")


def follow_folder(
    spark: SparkSession, source: str, sink: str, checkpoint: str, settings: MonitorSettings,
    bytes_per_batch: int = BYTES_PER_BATCH, delay: int = 0, hot_rows: int = HOT_ROWS, keep_days: float = 7.0,
) -> None:
    """Process what is new in a folder of Parquet log files, then return.

    Progress and state live in the checkpoint, so the next call goes on where
    this one stopped, also after a failure.  With a table of runs in
    ``settings`` each run has its own, and runs that are not in it are left
    out.  Records may be up to ``delay`` steps of their run out of order: each
    waits until its run is that much further on (``closing_stops`` for those
    that still wait when a log ends).  A record at or before the last step
    that was handled is left out and counted (``late_records``).
    """
    def handle(records: DataFrame, batch: int) -> None:
        tables = RunTables(records.sparkSession, f"{checkpoint}/runs", keep_days)
        micro_batch(records, batch, tables, sink, settings, delay, hot_rows)
    logs = spark.readStream.schema(LOG).option("maxBytesPerTrigger", bytes_per_batch).parquet(source)
    query = logs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    found = [int(name.split("=")[1]) for name in list_folder(spark, f"{checkpoint}/runs/state") if name.startswith("batch=")]
    return max(found, default=-1)


def closing_stops(spark: SparkSession, checkpoint: str, settings: MonitorSettings, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``run_id, stop_step, reason`` of runs that stop if no more records come and the waiting ones are handled.

    Nothing is changed: the stream may go on as if it hadn't been asked.
    """
    after = _last_batch(spark, checkpoint) + 1
    tables = RunTables(spark, f"{checkpoint}/runs")
    waited = tables.waiting(after)
    if waited is None:
        return spark.createDataFrame([], STOP)
    made, _ = next_rows(waited, tables.before(after), settings, close=True, hot_rows=hot_rows)
    return made.filter("stop_step IS NOT NULL").select("run_id", "stop_step", "reason")


def late_records(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``run_id, late``: records that came at or before the last step handled, and were left out."""
    after = _last_batch(spark, checkpoint) + 1
    return RunTables(spark, f"{checkpoint}/runs").before(after).select("run_id", "late")
