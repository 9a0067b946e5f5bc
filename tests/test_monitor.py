"""The monitor against a plain record-by-record model of its rules."""

import math
import random
import statistics

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import reset_chain as rc
from corpusloom.operators import chains, metrics, monitor
from corpusloom.operators.monitor import MonitorSettings
from corpusloom.session import list_folder, new_scratch, stage_table
from corpusloom.streaming import convergence as cv
from corpusloom.streaming.convergence import LOG, START, advance, follow_folder

LOG_SCHEMA = "run_id long, step long, loss double, lr double"


def arriving(df):
    """A log whose records arrive in the order of their rows."""
    return df.withColumn("arrival", F.monotonically_increasing_id())


def model(records, s):
    """Walk one run's (step, loss, lr) records; returns its trace and its stop."""
    ema = reference = None
    best, best_n, low, top, n, last = math.inf, 0, math.inf, 0.0, 0, None
    emas, trace = [], []
    for step, loss, lr in records:
        if s.hard_cap_step is not None and step >= s.hard_cap_step:
            return trace, (step, "hard_cap")
        if loss is None or step == last:
            continue
        last, n = step, n + 1
        ema = loss if ema is None else s.beta * ema + (1 - s.beta) * loss
        reference = ema if reference is None else reference
        emas.append(ema)
        if ema < low - 1e-12 or (low == math.inf and math.isfinite(ema)):
            best, best_n = ema, n
        low = min(low, ema) if math.isfinite(ema) else low
        row = dict(n=n, step=step, ema=ema, best=best, since=n - best_n)
        trace.append(row)
        near = emas[-s.window:]
        middle = statistics.median(near) if all(map(math.isfinite, near)) else math.nan
        spread = 0.0 if len(near) < 3 else 1.4826 * statistics.median(abs(e - middle) for e in near)
        sigma = max(spread, s.sigma_floor)
        tail = emas[-s.slope_window:]
        slope = 0.0 if len(tail) < 8 else float(np.polyfit(range(len(tail)), tail, 1)[0]) if all(
            map(math.isfinite, tail)) else math.nan
        row.update(sigma=sigma, slope=slope)
        if step < s.warmup or step / s.steps_total < s.exposure_floor:
            reference = ema
            continue
        if lr is not None and s.lr_fraction < 1:
            top = max(top, lr)
            row["lr_ok"] = lr <= top * s.lr_fraction + 1e-12
            if not row["lr_ok"]:
                continue
        if n < s.history:
            reference = ema
            continue
        drop = reference - ema
        if drop >= s.min_drop or drop / (sigma + 1e-12) >= s.min_sigmas:
            reference = ema
            continue
        flat = abs(slope) <= s.slope_threshold and sigma <= max(0.5 * s.sigma_floor, 0.05)
        if slope >= s.slope_threshold or (n - best_n >= s.patience and flat):
            return trace, (step, "trend")
    return trace, None


def falling(rng, length, end=1.0, noise=0.05, lr=True):
    return [
        (i + 1, end + 3 * math.exp(-i / 40) + rng.gauss(0, noise), 1e-3 * max(0.0, min(i / 20, (length - i) / length)) if lr else None)
        for i in range(length)
    ]


def make_runs():
    rng = random.Random(5)
    runs = {
        0: falling(rng, 260), 1: falling(rng, 500, lr=False), 2: falling(rng, 90, noise=0.5),
        3: [(i + 1, 2.0, None) for i in range(300)],
        4: [(i + 1, 5 - i * 0.01, None) for i in range(300)],
        5: falling(rng, 120, lr=False) + [(121 + i, 1.2 + 0.02 * i, None) for i in range(100)],
        6: [(i + 1, 4 - i * 0.02 if i < 150 else 1 + 0.001 * (i % 7), None) for i in range(420)],
        7: falling(rng, 5), 8: [(1, 3.0, 1e-3)],
        9: [(i + 1, 3.0, 1e-3 if i < 150 else 4e-4) for i in range(300)],
    }
    return runs


RUNS = make_runs()
COMMON = dict(steps_total=300, warmup=20, window=32, slope_window=24, history=24, block_rows=40)
VARIANTS = [
    MonitorSettings(**COMMON),
    MonitorSettings(**COMMON, hard_cap_step=200, slope_threshold=0.05),
    MonitorSettings(**COMMON, sigma_floor=0.01, min_drop=0.01, slope_threshold=0.004, lr_fraction=1.0),
    MonitorSettings(**{**COMMON, "block_rows": 4096}, sigma_floor=0.02, min_drop=0.002, min_sigmas=3.0, slope_threshold=0.002),
]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(run, *record) for run, records in RUNS.items() for record in records]
    random.Random(1).shuffle(rows)
    return arriving(spark.createDataFrame(rows, LOG_SCHEMA)).repartition(4).cache()


def stops_of(df):
    return {r.run_id: (r.stop_step, r.reason) for r in df.collect()}


@pytest.mark.parametrize("s", VARIANTS)
def test_stops_equal_the_model(log, s):
    want = {run: stop for run, (_, stop) in ((k, model(v, s)) for k, v in RUNS.items()) if stop}
    assert stops_of(monitor.stop_decisions(log, s)) == want


def test_the_variants_reach_every_reason():
    trends = [model(v, s)[1] for s in VARIANTS for v in RUNS.values()]
    assert {t and t[1] for t in trends} == {None, "trend", "hard_cap"}


def test_trace_equals_the_model(log):
    s = MonitorSettings(**COMMON, sigma_floor=0.01)
    open_ended = MonitorSettings(**COMMON, sigma_floor=0.01, min_drop=-1e9)  # always improved: walk to the end
    numbered = monitor.numbered_records(monitor.accepted_records(log))
    got = {}
    for r in monitor.monitor_trace(numbered, s).collect():
        got.setdefault(r.run_id, {})[r.n] = r
    for run, records in RUNS.items():
        trace, _ = model(records, open_ended)
        assert set(got[run]) == {t["n"] for t in trace} == set(range(1, len(records) + 1))
        for t in trace:
            r = got[run][t["n"]]
            assert (r.step, r.since_best) == (t["step"], t["since"])
            assert r.ema == pytest.approx(t["ema"], rel=1e-12) and r.best_ema == pytest.approx(t["best"], rel=1e-12)
            assert r.sigma == pytest.approx(t["sigma"], rel=1e-9) and r.slope == pytest.approx(t["slope"], abs=1e-9)
            if "lr_ok" in t:
                assert r.lr_ok == t["lr_ok"]
            assert r.cooldown == max(0, s.cooldown - t["since"])


def test_blocks_of_any_size_agree(log):
    numbered = monitor.numbered_records(log)
    want = {(r.run_id, r.n): r.ema for r in monitor.ema_series(numbered, MonitorSettings(**COMMON)).collect()}
    for rows, beta in ((31, 0.9), (7, 0.9), (2000, 0.9)):
        s = MonitorSettings(window=4, slope_window=4, block_rows=rows, beta=beta)
        for r in monitor.ema_series(numbered, s).collect():
            assert r.ema == pytest.approx(want[r.run_id, r.n], rel=1e-12)


def test_undefined_and_endless_losses_stay(spark):
    losses = {0: math.nan, 1: math.inf}
    rows = [(run, i + 1, bad if i == 50 else 1.0, None) for run, bad in losses.items() for i in range(200)]
    numbered = monitor.numbered_records(spark.createDataFrame(rows, LOG_SCHEMA))
    for r in monitor.ema_series(numbered, MonitorSettings(window=4, slope_window=4, block_rows=16)).collect():
        if r.n <= 50:
            assert r.ema == pytest.approx(1.0)
        else:
            assert math.isnan(r.ema) if r.run_id == 0 else r.ema == math.inf
    s = MonitorSettings(**COMMON)
    assert stops_of(monitor.stop_decisions(arriving(spark.createDataFrame(rows, LOG_SCHEMA)), s)) == {}


def test_repeated_steps_and_missing_losses(spark):
    rows = [(1, 1, 5.0, None), (1, 1, 4.0, None), (1, 2, None, None), (1, 3, 3.0, 0.1), (1, 3, 9.0, None)]
    df = arriving(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1))
    got = monitor.numbered_records(monitor.accepted_records(df)).orderBy("n").collect()
    assert [(r.step, r.n, r.loss) for r in got] == [(1, 1, 5.0), (3, 2, 3.0)]


def test_the_hard_cap_needs_no_loss(spark):
    rows = [(1, 5, 1.0, None), (1, 9, None, None), (1, 12, 1.0, None), (2, 3, 1.0, None)]
    df = arriving(spark.createDataFrame(rows, LOG_SCHEMA))
    s = MonitorSettings(hard_cap_step=8)
    assert stops_of(monitor.hard_cap_stops(df, s)) == stops_of(monitor.stop_decisions(df, s)) == {1: (9, "hard_cap")}


@pytest.mark.parametrize("block_rows", [16, 1024])
def test_null_losses_are_no_records(spark, block_rows):
    """The average skips them, and numbering goes on without a gap."""
    rows = [(1, i + 1, None if i == 4 else 3.0, None) for i in range(10)] + [(1, 3, 50.0, None)]
    records = monitor.accepted_records(arriving(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)))
    series = monitor.ema_series(monitor.numbered_records(records), MonitorSettings(block_rows=block_rows)).collect()
    assert sorted((r.n, r.step) for r in series) == list(zip(range(1, 10), [1, 2, 3, 4, 6, 7, 8, 9, 10]))
    assert all(r.ema == pytest.approx(3.0) for r in series)


def test_nulls_and_repeats_in_batch_and_stream(spark):
    s = VARIANTS[0]
    rng, rows = random.Random(8), []
    for run, records in RUNS.items():
        for step, loss, lr in records:
            rows.append((run, step, None if rng.random() < 0.1 else loss, lr))
            if rng.random() < 0.2:
                rows.append((run, step, loss + rng.gauss(0, 2), lr))
    log = arriving(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1)).cache()
    want = {run: model([r[1:] for r in rows if r[0] == run], s)[1] for run in RUNS}
    want = {run: stop for run, stop in want.items() if stop}
    assert stops_of(monitor.stop_decisions(log, s)) == want
    source, sink, state = (new_scratch(spark, f"n-{p}") for p in ("in", "out", "state"))
    for low, high in ((0, 70), (70, 10_000)):
        log.filter(f"step > {low} and step <= {high}").repartition(3).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s)
    assert stops_of(spark.read.schema("run_id bigint, stop_step bigint, reason string").parquet(sink)) == want


def test_runs_with_settings_of_their_own(spark, log):
    own = {run: VARIANTS[0].__class__(
        steps_total=100 + 40 * run, warmup=5 + run, hard_cap_step=[150, None, 210][run % 3], window=20 + 5 * run,
        slope_window=10 + 4 * run, history=12 + run, block_rows=40) for run in RUNS}
    fields = monitor.PER_RUN
    runs = spark.createDataFrame(
        [(run, *[getattr(s, f) for f in fields]) for run, s in own.items()],
        "run_id long, " + ", ".join(f"{f} long" for f in fields))
    together = MonitorSettings(runs=runs, window=65, slope_window=46, block_rows=40)
    want = {run: model(RUNS[run], s)[1] for run, s in own.items()}
    assert stops_of(monitor.stop_decisions(log, together)) == {run: stop for run, stop in want.items() if stop}


def test_settings_of_a_run_plan(spark):
    plan = spark.createDataFrame([(1, 100, 75, 80), (2, 40_000, 400, 30_000)],
                                 "run_id long, total_steps long, warmup_steps long, hard_cap_step long")
    s = MonitorSettings.for_runs(plan)
    got = {r.run_id: (r.window, r.slope_window, r.history, r.warmup) for r in s.runs.collect()}
    assert got == {1: (128, 96, 42, 75), 2: (600, 450, 200, 400)} and s.lookback == 599


def test_a_long_falling_run_stays_cheap(spark):
    """200,000 records that fall steadily, at the default windows."""
    import time
    log = spark.range(200_000).select(
        F.lit(1).cast("bigint").alias("run_id"), (F.col("id") + 1).alias("step"), F.col("id").alias("arrival"),
        (4.0 - F.col("id") * 1e-5).alias("loss"), F.lit(None).cast("double").alias("lr"))
    s = MonitorSettings(steps_total=200_000)
    begun = time.time()
    assert stops_of(monitor.stop_decisions(log, s)) == {}
    assert time.time() - begun < 60
    level = 4.0 - np.arange(200_000) * 1e-5 + s.min_drop
    summary = rc.summarise(level[1024:2048], level[1024:2048] - s.min_drop, np.zeros(1024, bool), np.arange(1024), None,
                           level[1023] - s.min_drop, level[1023])
    assert len(summary["levels"]) <= 1024
    steep = 4.0 - np.arange(2048) * 1e-3
    short = rc.summarise(steep[1024:] + 0.04, steep[1024:], np.zeros(1024, bool), np.arange(1024), None,
                         steep[1023], steep[1023] + 0.04)
    assert len(short["levels"]) <= 42


def test_one_user_with_most_of_an_hour(spark):
    from datetime import datetime, timedelta
    start = datetime(2024, 1, 1, 5)
    rows = [(i, start + timedelta(milliseconds=300 * (i * 7919 % 3000)), 1 if i % 10 else 2, float(i)) for i in range(3000)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double")
    got = {(r.run_id, r.step): r.loss for r in monitor.event_log(events).collect()}
    for run in (1, 2):
        ordered = sorted((r for r in rows if r[2] == run), key=lambda r: (r[1], r[0]))
        assert [got[run, i + 1] for i in range(len(ordered))] == [r[3] for r in ordered]


def test_settings_grow_with_the_run():
    s = MonitorSettings.for_run(10_000)
    assert (s.window, s.slope_window, s.history) == (150, 112, 50)
    assert MonitorSettings.for_run(0).window == 128 and MonitorSettings.for_run(1, window=900).window == 512
    with pytest.raises(ValueError):
        MonitorSettings(beta=1.0).smooth_rows
    assert MonitorSettings(beta=1e-3).smooth_rows == 96


@pytest.mark.parametrize("beta", [0.05, 1e-3])
def test_a_small_beta_has_short_blocks(spark, log, beta):
    s = MonitorSettings(**{**COMMON, "window": 128}, beta=beta)
    want = {run: stop for run, (_, stop) in ((k, model(v, s)) for k, v in RUNS.items()) if stop}
    assert stops_of(monitor.stop_decisions(log, s)) == want


# --- reset chains -------------------------------------------------------------

items = st.lists(
    st.tuples(st.sampled_from([-math.inf, 0.0, 1.0, 2.0, 3.0, 4.0, math.nan]), st.sampled_from([0.5, 1.5, 2.5, 3.5]), st.booleans()),
    max_size=12,
)


@settings(max_examples=300, deadline=None)
@given(items, items, items, st.sampled_from([-1.0, 0.0, 1.2, 2.0, 3.7, 9.0, math.inf]))
def test_joined_summaries_equal_one_walk(a, b, c, x):
    def columns(rows):
        level, value, flagged = (np.array(col) for col in zip(*rows)) if rows else (np.array([]),) * 3
        return level.astype(float), value.astype(float), flagged.astype(bool)

    level, value, flagged = columns(a + b + c)
    fired, end = rc.follow(level, value, flagged, x)
    out = value[fired[-1]] if fired else x
    mark = end if end is not None else (fired[-1] if fired else None)

    parts, start = [], 0
    for rows in (a, b, c):
        lv, vl, fl = columns(rows)
        parts.append(rc.summarise(lv, vl, fl, np.arange(start, start + len(rows))))
        start += len(rows)
    for whole in (rc.join(rc.join(*parts[:2]), parts[2]), rc.join(parts[0], rc.join(*parts[1:]))):
        assert rc.apply(whole, x) == (out, mark, end is not None)


def test_runs_longer_than_a_fan(log, monkeypatch):
    """With a fan of three blocks, runs need several summaries of summaries."""
    s = VARIANTS[2]
    want = stops_of(monitor.stop_decisions(log, s))
    monkeypatch.setattr(chains, "FAN", 3)
    assert stops_of(monitor.stop_decisions(log, s)) == want


def test_small_arrow_batches_do_not_cut_groups(spark, log):
    s = VARIANTS[2]
    want = stops_of(monitor.stop_decisions(log, s))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert stops_of(monitor.stop_decisions(log, s)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# --- streaming ----------------------------------------------------------------

@pytest.mark.parametrize("s", VARIANTS[:3])
@pytest.mark.parametrize("size", [1, 17, 10_000])
def test_advancing_in_pieces_equals_the_model(s, size):
    import pandas as pd

    for records in RUNS.values():
        state, stop = START, None
        for at in range(0, len(records), size):
            piece = pd.DataFrame(records[at:at + size], columns=["step", "loss", "lr"])
            piece["arrival"] = range(len(piece))
            piece["loss_seen"], piece["lr_seen"] = piece["loss"].notna(), piece["lr"].notna()
            state, stop = advance(s, state, piece.sample(frac=1, random_state=at))
            if stop:
                break
            assert len(state[8]) <= s.lookback
        assert stop == model(records, s)[1]


def test_stream_equals_batch_over_restarts(spark, log):
    s = VARIANTS[1]
    source, sink, state = (new_scratch(spark, f"t-{p}") for p in ("in", "out", "state"))
    for low, high in ((0, 60), (60, 61), (61, 10_000)):
        log.filter(f"step > {low} and step <= {high}").repartition(3).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s)
    streamed = spark.read.schema("run_id bigint, stop_step bigint, reason string").parquet(sink)
    assert streamed.count() == streamed.select("run_id").distinct().count()
    assert stops_of(streamed) == stops_of(monitor.stop_decisions(log, s))
    assert LOG.startswith("run_id")


def stops_in(spark, sink):
    return stops_of(spark.read.parquet(sink).select("run_id", "stop_step", "reason"))


def own_settings(spark, log):
    """Settings of their own for all runs but one, which is left out."""
    kept = sorted(RUNS)[:-1]
    own = {run: MonitorSettings(
        steps_total=100 + 40 * run, warmup=5 + run, hard_cap_step=[150, None, 210][run % 3], window=20 + 5 * run,
        slope_window=10 + 4 * run, history=12 + run, block_rows=40) for run in kept}
    fields = monitor.PER_RUN
    runs = spark.createDataFrame(
        [(run, *[getattr(s, f) for f in fields]) for run, s in own.items()], "run_id long, " + ", ".join(f"{f} long" for f in fields))
    return own, MonitorSettings(runs=runs, window=65, slope_window=46, block_rows=40)


def test_stream_with_settings_of_each_run(spark, log, hot_rows=60):
    own, together = own_settings(spark, log)
    want = {run: stop for run, stop in ((r, model(RUNS[r], s)[1]) for r, s in own.items()) if stop}
    source, sink, state = (new_scratch(spark, f"o-{p}") for p in ("in", "out", "state"))
    for low, high in ((0, 45), (45, 10_000)):
        log.filter(f"step > {low} and step <= {high}").coalesce(1).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, together, hot_rows=hot_rows)
    assert stops_in(spark, sink) == want


def test_blocks_of_hot_runs_equal_batch(spark, log, s=VARIANTS[2]):
    source, sink, state = (new_scratch(spark, f"h-{p}") for p in ("in", "out", "state"))
    for low, high in ((0, 41), (41, 42), (42, 10_000)):
        log.filter(f"step > {low} and step <= {high}").coalesce(1).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s, hot_rows=0)
    assert stops_in(spark, sink) == stops_of(monitor.stop_decisions(log, s))


def test_state_is_alike_by_blocks_and_by_record(spark, log, s=VARIANTS[0]):
    """The two ways of advancing a run leave the same state, piece after piece."""
    known = {hot: spark.createDataFrame([], cv.RUN) for hot in (0, 10_000)}
    for low, high in ((0, 30), (30, 31), (31, 150)):
        part = log.filter(f"step > {low} and step <= {high}")
        for hot in known:
            made, _ = cv.next_rows(part, known[hot], s, hot_rows=hot)
            known[hot] = stage_table(made, "rows")
        left, right = ({r["run_id"]: r.asDict() for r in known[hot].collect()} for hot in known)
        assert left.keys() == right.keys()
        for run in left:
            for name in ("n", "last_step", "best_n", "stopped", "top_step", "late", "stop_step", "reason"):
                if not left[run]["stopped"] or name in ("stopped", "stop_step", "reason"):
                    assert left[run][name] == right[run][name], (run, name)
            if not left[run]["stopped"]:
                for name in ("ema", "reference", "best", "top_lr", "low", "tail"):
                    assert np.allclose(left[run][name], right[run][name], rtol=1e-9, atol=1e-12, equal_nan=True), (run, name)


def test_a_hot_run_is_dealt_to_many_tasks(spark):
    log = spark.range(40_000).select(
        F.lit(1).cast("bigint").alias("run_id"), (F.col("id") + 1).alias("step"), F.col("id").alias("arrival"),
        (2.0 + F.sin(F.col("id") / 900) / 5).alias("loss"), F.lit(None).cast("double").alias("lr"))
    s = MonitorSettings(steps_total=40_000, window=64, slope_window=48, block_rows=512)
    known = spark.createDataFrame([], cv.RUN)
    for low, high in ((0, 15_000), (15_000, 40_000)):
        part = log.filter(f"step > {low} and step <= {high}")
        made, _ = cv.next_rows(part, known, s, hot_rows=1000)
        known = stage_table(made, "hot")
        if known.filter("stopped").count():
            break
    want = monitor.stop_decisions(log, s).collect()
    assert [(r["stop_step"], r["reason"]) for r in known.filter("stop_step is not null").collect()] == [
        (r["stop_step"], r["reason"]) for r in want]
    numbered = monitor.numbered_records(monitor.accepted_records(log))
    blocks = monitor.window_blocks(monitor.smoothed(numbered, s), s).groupBy("run_id", "block").count()
    assert blocks.count() == -(-40_000 // 512) and blocks.agg(F.max("count")).first()[0] <= 512 + s.lookback


def test_records_out_of_order_within_the_delay(spark, log, hot_rows=70):
    import random
    s, delay, rng = VARIANTS[1], 12, random.Random(3)
    rows = [r.asDict() for r in log.collect()]
    for r in rows:  # a record comes up to ``delay`` steps late
        r["when"] = r["step"] + rng.uniform(0, delay - 1)
    source, sink, state = (new_scratch(spark, f"d-{p}") for p in ("in", "out", "state"))
    edges = [-1, 30, 140, 10_000]
    for low, high in zip(edges, edges[1:]):
        part = [tuple(r[c] for c in ("run_id", "step", "arrival", "loss", "lr")) for r in rows if low < r["when"] <= high]
        rng.shuffle(part)
        spark.createDataFrame(part, LOG).repartition(2).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s, delay=delay, hot_rows=hot_rows)
    closing = stops_of(cv.closing_stops(spark, state, s, hot_rows=hot_rows))
    streamed = stops_in(spark, sink)
    assert not closing.keys() & streamed.keys()
    assert {**streamed, **closing} == stops_of(monitor.stop_decisions(log, s))
    assert {r["late"] for r in cv.late_records(spark, state).collect()} == {0}


def test_late_records_are_counted(spark):
    s = MonitorSettings(steps_total=50, window=8, slope_window=8, history=8, block_rows=16)
    source, sink, state = (new_scratch(spark, f"l-{p}") for p in ("in", "out", "state"))
    first = [(run, step, step, 1.0, None) for run in (1, 2) for step in range(1, 31)]
    second = [(1, 18, 99, 9.0, None), (1, 31, 99, 1.0, None), (2, 5, 99, 9.0, None), (2, 6, 99, None, None),
              (2, 29, 98, 7.0, None), (None, 3, 3, 1.0, None), (2, None, 3, 1.0, None)]
    for part in (first, second):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s, delay=10)
    assert {r["run_id"]: r["late"] for r in cv.late_records(spark, state).collect()} == {1: 1, 2: 2}


def test_a_call_without_delay_takes_what_waits(spark):
    s = MonitorSettings(steps_total=50, window=8, slope_window=8, history=8, block_rows=16, hard_cap_step=20)
    source, sink, state = (new_scratch(spark, f"w-{p}") for p in ("in", "out", "state"))
    for part, delay in (([(1, step, step, 1.0, None) for step in range(1, 26)], 30), ([(1, 26, 26, 1.0, None)], 0)):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s, delay=delay)
    assert stops_in(spark, sink) == {1: (20, "hard_cap")}
    assert cv.closing_stops(spark, state, s).count() == 0


def test_records_of_stopped_runs_meet_in_no_task(spark, monkeypatch):
    """Runs that have stopped, or have no settings, may send any number of records; the stopped ones' are counted."""
    fields = monitor.PER_RUN
    own = spark.createDataFrame([(run, 200, 5, 40, 16, 12, 8) for run in (1, 2)], "run_id long, " + ", ".join(f"{f} long" for f in fields))
    s = MonitorSettings(runs=own, window=16, slope_window=12, history=8, block_rows=16)

    def records(sizes):
        rows = [(run, step, step, 2.0 + run / step, None) for run, (low, high) in sizes.items() for step in range(low, high)]
        return spark.createDataFrame(rows, LOG)
    known, _ = cv.next_rows(records({1: (1, 45), 2: (1, 20), 3: (1, 9)}), spark.createDataFrame([], cv.RUN), s)
    known = stage_table(known, "known")
    assert {r["run_id"]: r["stop_step"] for r in known.collect()} == {1: 40, 2: None}
    later = records({1: (10, 400), 2: (20, 35), 3: (9, 500)})
    want, _ = cv.next_rows(later, known, s, hot_rows=10_000)
    want = sorted(map(str, want.collect()))
    seen, advanced = {}, cv._advanced

    def spied(rows, *rest):
        seen.update({r["run_id"]: r["count"] for r in rows.groupBy("run_id").count().collect()})
        return advanced(rows, *rest)
    monkeypatch.setattr(cv, "_advanced", spied)
    made, _ = cv.next_rows(later, known, s, hot_rows=100)
    assert sorted(map(str, made.collect())) == want
    assert {r["run_id"]: r["late"] for r in made.collect()} == {1: 30, 2: 0}
    assert seen == {2: 15}


def test_a_slice_longer_than_a_micro_batch_arrives_in_order(spark):
    from corpusloom.plans.queries import _streamed
    log = spark.range(8000).select(
        (F.col("id") % 8).alias("run_id"), (F.floor(F.col("id") / 8) + 1).alias("step"), F.col("id").alias("arrival"),
        (F.lit(2.0) + F.rand(4)).alias("loss"), F.lit(None).cast("double").alias("lr")).repartition(4)
    log, s = stage_table(log, "slice"), MonitorSettings(steps_total=1000, warmup=900, window=16, slope_window=12, hard_cap_step=700)
    found = _streamed(log, s, [0, None], bytes_per_batch=100_000)
    assert stops_of(found) == {run: (700, "hard_cap") for run in range(8)}


def test_versions_become_snapshots(spark, log, monkeypatch):
    monkeypatch.setattr(cv, "SNAPSHOT_EVERY", 2)
    s = VARIANTS[1]
    source, sink, state = (new_scratch(spark, f"v-{p}") for p in ("in", "out", "state"))
    edges = [0, 20, 40, 55, 120, 10_000]
    for low, high in zip(edges, edges[1:]):
        log.filter(f"step > {low} and step <= {high}").coalesce(1).write.mode("append").parquet(source)
        follow_folder(spark, source, sink, state, s)
    assert stops_in(spark, sink) == stops_of(monitor.stop_decisions(log, s))
    kept = list_folder(spark, f"{state}/runs/state")
    assert kept == ["batch=2", "batch=3", "batch=4"] and list_folder(spark, f"{state}/runs/snapshot") == ["batch=2", "batch=4"]


def test_a_repeated_micro_batch_changes_nothing(spark, log):
    s, folder = VARIANTS[1], new_scratch(spark, "again")
    tables = cv.RunTables(spark, f"{folder}/runs")
    for batch, (low, high) in enumerate(((0, 60), (60, 120))):
        part = log.filter(f"step > {low} and step <= {high}")
        for _ in range(2):
            cv.micro_batch(part, batch, tables, f"{folder}/out", s)
    first = sorted(map(str, tables.before(2).drop("seen").collect()))
    cv.micro_batch(part, 1, tables, f"{folder}/out", s)
    assert sorted(map(str, tables.before(2).drop("seen").collect())) == first


# --- metrics ------------------------------------------------------------------

def test_perplexity_shift_mask_and_overflow(spark):
    rows = [(1, [[0.0, 2.0], [1.0, 1.0], [9.0, 9.0]], [0, 1, -100]), (2, [[0.0, 2000.0], [5.0, 5.0]], [1, 0]), (3, [[1.0, 1.0]], [0])]
    df = spark.createDataFrame(rows, "seq int, logits array<array<double>>, labels array<int>")
    losses = metrics.position_losses(metrics.shifted_positions(df, "logits", "labels"), "logits", "label")
    got = {r.seq: r for r in metrics.perplexity(losses, ["seq"]).collect()}
    assert set(got) == {1, 2}
    assert got[1].n_positions == 1 and got[1].eval_loss == pytest.approx(math.log(1 + math.exp(-2)))
    assert got[2].eval_loss == pytest.approx(2000) and got[2].perplexity == math.inf


def test_losses_from_chunks(spark):
    inf, nan = math.inf, math.nan
    scores = {
        1: ([0.5, 2.0, -1.0, 3.0, 0.0], 3), 2: ([1000.0, -1000.0, 999.0, 0.0, 1.0], 1), 3: ([-inf, -inf, 1.0, 2.0, -inf], 2),
        4: ([-inf] * 5, 0), 5: ([0.0, nan, 1.0, 2.0, 3.0], 0), 6: ([1.0] * 5, -100), 7: ([1.0] * 5, 9), 8: ([-inf, 5.0, 1.0, 1.0, 1.0], 0)}
    rows = [(i, s, x[s:s + size], label) for i, (x, label) in scores.items() for size in (2,) for s in range(0, 5, size)]
    chunks = spark.createDataFrame(rows + [(1, 5, [], 3)], "i int, start int, x array<double>, label int").repartition(3)
    got = {r.i: r.loss for r in metrics.chunk_losses(chunks, ["i"], "start", "x", "label").collect()}
    whole = spark.createDataFrame([(i, x, label) for i, (x, label) in scores.items()], "i int, x array<double>, label int")
    want = {r.i: r.loss for r in metrics.position_losses(whole, "x", "label").collect()}
    assert got.keys() == want.keys() == {1, 2, 3, 4, 5, 7, 8}
    for i in (1, 2, 3):
        assert got[i] == pytest.approx(want[i], rel=1e-12)
    assert got[8] == inf and math.isnan(got[4]) and math.isnan(got[5]) and got[7] is None


@pytest.mark.parametrize("offset", [0.0, 1e9, -1e6])
def test_slope_from_running_sums(spark, offset):
    rng = random.Random(2)
    rows = [(run, i + 1, i + 1, offset + rng.gauss(0, 1) + i * 0.01 * run) for run, size in ((1, 400), (2, 7), (3, 33)) for i in range(size)]
    rows += [(4, i + 1, i + 1, math.inf if i >= 50 else 1.0) for i in range(90)]
    rows += [(5, i + 1, i + 1, math.nan if i >= 5 else 1.0) for i in range(60)]
    smooth = spark.createDataFrame(rows, "run_id long, n long, step long, ema double").withColumns(
        {"lr": F.lit(0.0), "_window": F.lit(32).cast("bigint"), "_slope_window": F.lit(24).cast("bigint")})
    s = MonitorSettings(**COMMON)
    got = {(r.run_id, r.n): r.slope for r in monitor.with_windows(smooth, s, sigma=False).collect()}
    assert len(got) == len(rows)
    from corpusloom.functions.windows import slope_of_last
    for run in range(1, 6):
        series = np.array([r[3] for r in rows if r[0] == run])
        with np.errstate(invalid="ignore"):
            want = slope_of_last(series, len(series), 24)
            exact = slope_of_last(series - (offset if run < 4 else 0), len(series), 24)
        for n, (w, e) in enumerate(zip(want, exact), 1):
            assert got[run, n] == pytest.approx(e, abs=1e-9 * max(1, abs(offset) * 1e-3), nan_ok=True), (run, n)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 96, 512, 700])
@pytest.mark.parametrize("kind", ["noise", "ties", "falling", "offset"])
def test_spread_by_order_equals_sorted_windows(monkeypatch, size, kind):
    from corpusloom.functions import windows
    rng = np.random.default_rng(size)
    series = {"noise": rng.standard_normal(900), "ties": rng.integers(0, 4, 900) / 3, "falling": 5 - np.arange(900) * 0.01,
              "offset": 1e9 + rng.standard_normal(900)}[kind]
    for fresh in (900, 300, 1):
        monkeypatch.setattr(windows, "TREE_FROM", 1)
        by_tree = windows.sigma_of_last(series, fresh, size)
        monkeypatch.setattr(windows, "TREE_FROM", 10 ** 9)
        assert (by_tree == windows.sigma_of_last(series, fresh, size)).all()


def test_order_statistics_of_any_stretch():
    from corpusloom.functions.windows import OrderStatistics
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 64, 65):
        series = rng.integers(0, 9, n).astype(float)
        spans = [(a, b, k) for a in range(n) for b in range(a + 1, n + 1) for k in (0, (b - a) // 2, b - a - 1)]
        start, end, k = map(np.array, zip(*spans))
        want = [sorted(series[a:b])[i] for a, b, i in spans]
        assert OrderStatistics(series).smallest(start, end, k).tolist() == want


def _windows_both_ways(monkeypatch, series, fresh, size):
    from corpusloom.functions import windows
    found = []
    for bound in (1, 10 ** 9):
        monkeypatch.setattr(windows, "TREE_FROM", bound)
        monkeypatch.setattr(windows, "SUMS_FROM", bound)
        with np.errstate(invalid="ignore"):
            found.append((windows.sigma_of_last(series, fresh, size), windows.slope_of_last(series, fresh, size)))
    return found


@pytest.mark.parametrize("size", [1, 7, 8, 33, 96, 250])
@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_slope_by_sums_equals_fitted_windows(monkeypatch, size, offset):
    series = offset + np.random.default_rng(size).standard_normal(301).cumsum()
    for fresh in (301, 100, 1):
        (_, by_sums), (_, fitted) = _windows_both_ways(monkeypatch, series, fresh, size)
        assert by_sums == pytest.approx(fitted, abs=1e-12 * max(1, offset))


@pytest.mark.parametrize("seed", range(12))
def test_wild_values_in_long_windows(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    series, size = rng.standard_normal(90), int(rng.integers(8, 40))
    if seed % 2:
        series[rng.integers(90):] = rng.choice([np.inf, -np.inf, np.nan])
    else:
        series[rng.integers(0, 90, 4)] = rng.choice([np.inf, -np.inf, np.nan], 4)
    (sigma, slope), (want_sigma, want_slope) = _windows_both_ways(monkeypatch, series, 80, size)
    assert np.array_equal(sigma, want_sigma, equal_nan=True)
    finite = np.isfinite(want_slope)
    assert slope[finite] == pytest.approx(want_slope[finite], abs=1e-12)
    assert np.array_equal(slope[~finite], want_slope[~finite], equal_nan=True)


@pytest.mark.parametrize("size,fresh,wild", [(13500, 18000, False), (13500, 18000, True), (400, 60000, False)])
def test_windows_take_no_room_of_their_own(size, fresh, wild):
    import tracemalloc

    from corpusloom.functions import windows
    series = np.random.default_rng(3).standard_normal(fresh + size)
    if wild:
        series[-fresh // 2:] = np.nan
    tracemalloc.start()
    with np.errstate(invalid="ignore"):
        windows.slope_of_last(series, fresh, size)
        if wild:
            windows.sigma_of_last(series, fresh, size)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6


def test_a_long_slice_of_a_stream_takes_no_room_for_its_windows():
    import tracemalloc
    rng = np.random.default_rng(5)
    size = 12_000
    records = {"step": np.arange(size), "arrival": np.arange(size), "loss": 3 + rng.standard_normal(size), "lr": np.zeros(size),
               "loss_seen": np.ones(size, dtype=bool), "lr_seen": np.zeros(size, dtype=bool)}
    s = MonitorSettings(steps_total=size, warmup=20, window=6000, slope_window=4500, history=2000)
    tracemalloc.start()
    whole, stop = advance(s, START, records)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6
    state = START
    for at in range(0, size, 5000):
        state, found = advance(s, state, {name: values[at: at + 5000] for name, values in records.items()})
        if found:
            break
    assert found == stop and (stop or whole[:2] == state[:2])
