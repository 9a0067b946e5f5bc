"""The registered queries: one per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions import plan_math as pm
from corpusloom.functions.labels import answer_only
from corpusloom.functions.text import (
    add_once, clean_text, drop_tags, keep_nonblank, strip,
)
from corpusloom.operators import batches, lengths, metrics, monitor, ordering, prompts, roles, tokens
from corpusloom.plans.run_plan import run_plan
from corpusloom.session import new_scratch, spread, stage_table
from corpusloom.sources import images
from corpusloom.sources.export import export_tokens, read_tokens, write_tokens
from corpusloom.sources.footers import file_rows
from corpusloom.sources.ledger import new_names
from corpusloom.sources.tables import TEST_TABLES, load_tables
from corpusloom.streaming.convergence import BYTES_PER_BATCH, closing_stops, follow_folder

SEED = 7
VOCABULARY = 2000
BATCH = 8
EXTRA_DENIED = ["@", "License"]
# Decimal ties would round by floating-point noise; this moves values off them.
OFF_TIES = 0.1372639

SMALL = dict(steps_total=60, window=32, slope_window=24, history=24, warmup=10, block_rows=40)
TREND = monitor.MonitorSettings(**SMALL, hard_cap_step=57)
CALM = monitor.MonitorSettings(
    **SMALL, sigma_floor=0.004, min_drop=0.001, slope_threshold=0.0004
)
CALM_SCALE = 1000.0
PLANNED_SCALE = 100.0


def steady(value: Column, digits: int = 4) -> Column:
    return F.round(value + F.lit(OFF_TIES / 10 ** digits), digits)


def joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- text ---------------------------------------------------------------------

def clean_documents(mode: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
        return docs.select("doc_id", clean_text(F.col("text"), mode).alias("text"))
    return run


def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", clean_text(F.col("html"), "other").alias("text"))


def strip_tags_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select("page_id", drop_tags(F.col("html")).alias("text"))


def denylist_hits(spark: SparkSession, sf: str) -> DataFrame:
    listed = F.array(*[F.lit(x) for x in fv.DENYLIST + EXTRA_DENIED])
    hits = F.filter(listed, lambda literal: F.contains(F.col("text"), literal))
    found = table(spark, sf, "documents").select("source", F.explode(hits).alias("literal"))
    return found.groupBy("source", "literal").agg(F.count("*").alias("n_hits"))


# --- roles, ledger, order -----------------------------------------------------

def catalog_detect_mode(spark: SparkSession, sf: str) -> DataFrame:
    tables = load_tables(spark, sf, TEST_TABLES)
    found = roles.detect_tasks(roles.column_catalog(spark, tables))
    return found.join(roles.role_coverage(tables), "table_name").select("table_name", "task", "n_rows")


def catalog_role_map(spark: SparkSession, sf: str) -> DataFrame:
    tables = load_tables(spark, sf, TEST_TABLES)
    mapped = roles.map_roles(roles.column_catalog(spark, tables))
    return mapped.join(roles.role_coverage(tables), "table_name")


def ledger_new_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    used = docs.filter(F.col("text").contains("@")).select(F.col("source").alias("name"))
    return new_names(docs, used, "source")


def seeded_shuffle_key(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id")
    return ordering.seeded_shuffle(docs, SEED, "doc_id")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.question_answer_pairs(table(spark, sf, "conversations"))


def prompt_preview(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.preview(pairs(spark, sf), "question", "answer", SEED, "conv_id", "turn")


# --- prompts ------------------------------------------------------------------

def sft_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.prompt_table(
        pairs(spark, sf).withColumnRenamed("answer", "response"), keys=["conv_id", "turn"]
    )


def nonempty_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    cleaned = clean_text(F.col("text"), "other", denylist=fv.DENYLIST + EXTRA_DENIED)
    return keep_nonblank(docs, cleaned)


def chat_render(spark: SparkSession, sf: str) -> DataFrame:
    return prompts.whole_conversations(prompts.render_conversations(table(spark, sf, "conversations")))


def causal_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return prompts.prompt_table(docs, keys=["doc_id"])


def instruction_template(spark: SparkSession, sf: str) -> DataFrame:
    system = (
        table(spark, sf, "conversations").filter(F.col("role") == "system")
        .groupBy("conv_id").agg(F.min_by("text", "turn").alias("instruction"))
    )
    block = F.floor(F.col("turn") / 1024)
    asked = pairs(spark, sf).withColumn("_block", block)
    # The instruction goes to each block of a conversation, so a long one is joined in many tasks.
    told = asked.select("conv_id", "_block").distinct().join(system, "conv_id")
    asked = asked.join(told, ["conv_id", "_block"], "left")
    text = prompts.instruction_text(
        F.coalesce("instruction", "question"),
        F.when(F.col("instruction").isNotNull(), F.col("question")), F.col("answer"), "code",
    )
    return asked.select("conv_id", "turn", text.alias("text"))


def multimodal_text(spark: SparkSession, sf: str) -> DataFrame:
    text = prompts.multimodal_text(F.col("question"), F.col("answer"), "latex")
    return pairs(spark, sf).select("conv_id", "turn", text.alias("text"))


def vision_prompt(spark: SparkSession, sf: str) -> DataFrame:
    text = prompts.vision_prompt(strip(F.col("question")), strip(F.col("answer")))
    return pairs(spark, sf).select("conv_id", "turn", text.alias("text"))


def retention_report(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("source", "text"))
    cleaned = clean_text(F.col("text"), "other", denylist=fv.DENYLIST + EXTRA_DENIED)
    return prompts.retention_report(docs, cleaned, "source")


# --- lengths ------------------------------------------------------------------

def _lengths(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    return docs.select("doc_id", "lang", lengths.token_length(F.col("text")).alias("length"))


def token_length(spark: SparkSession, sf: str) -> DataFrame:
    return _lengths(spark, sf).select("doc_id", "length")


def length_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return lengths.length_percentiles(_lengths(spark, sf), ["lang"])


def auto_max_length(spark: SparkSession, sf: str) -> DataFrame:
    counted = lengths.counted_lengths(_lengths(spark, sf), "lang", "all")
    return lengths.length_cap(counted, ["lang"], weight=F.col("_rows"))


# --- tokens -------------------------------------------------------------------

def vocab_topk(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("text"))
    return tokens.top_vocabulary(docs, F.col("text"), VOCABULARY)


def _measured(texts: DataFrame, n_special: int = 1) -> tuple[DataFrame, Column]:
    """Texts staged with their token counts, and the length cap that follows from them."""
    staged = stage_table(texts.withColumn("length", lengths.token_length(F.col("text"), n_special)), "measured")
    return staged.drop("length"), lengths.cap_value(staged)


def _encoded(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as ids, cut at the derived cap; staged, since batching reads them more than once."""
    docs, cap = _measured(spread(table(spark, sf, "documents").select("doc_id", "text")))
    vocabulary = tokens.top_vocabulary(docs, F.col("text"), VOCABULARY)
    return stage_table(tokens.encode_text(docs, F.col("text"), vocabulary, VOCABULARY, cap).drop("text"), "coded")


def tokenize_truncate(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf).select("doc_id", joined(F.col("input_ids")).alias("ids"), "length")


def causal_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf).select(
        "doc_id", joined(F.col("attention_mask")).alias("mask"), joined(F.col("labels")).alias("labels")
    )


def tokenized_export(spark: SparkSession, sf: str) -> DataFrame:
    path = new_scratch(spark, "tokens")
    write_tokens(_encoded(spark, sf), path, rows_per_file=500)
    back = spark.read.parquet(path)
    return back.select(
        "doc_id", joined(F.col("input_ids")).alias("ids"), joined(F.col("labels")).alias("labels"), "length"
    )


def export_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows exported in groups of files: the second group fails, and a later call goes on there."""
    source, path = new_scratch(spark, "coded"), new_scratch(spark, "export")
    _encoded(spark, sf).repartition(4, "doc_id").write.parquet(source)
    seen: list[int] = []

    def make(rows: DataFrame) -> DataFrame:
        seen.append(1)
        if len(seen) == 2:
            raise InterruptedError("killed")
        return rows
    for _ in range(2):
        try:
            export_tokens(spark, source, make, path, max_length=1024, group_bytes=1)
        except InterruptedError:
            continue
    return read_tokens(spark, path).select(
        "doc_id", joined(F.col("input_ids")).alias("ids"), joined(F.col("labels")).alias("labels"), "length")


def _encoded_pairs(spark: SparkSession, sf: str) -> DataFrame:
    text = prompts.vision_prompt(F.col("question"), F.col("answer"))
    prepared, cap = _measured(pairs(spark, sf).select("conv_id", "turn", tokens.split_marks(text).alias("text")))
    turns = table(spark, sf, "conversations")
    vocabulary = tokens.top_vocabulary(turns, F.col("text"), VOCABULARY)
    coded = tokens.encode_text(prepared, F.col("text"), vocabulary, VOCABULARY, cap)
    return stage_table(coded.drop("text").withColumn(
        "labels", answer_only(F.col("input_ids"), tokens.ASSISTANT_ID)
    ), "coded")


def answer_only_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded_pairs(spark, sf).select(
        "conv_id", "turn", joined(F.col("input_ids")).alias("ids"), joined(F.col("labels")).alias("labels")
    )


def nonempty_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "source", "text"))
    cleaned = clean_text(F.col("text"), "math", denylist=fv.DENYLIST + EXTRA_DENIED)
    prepared, cap = _measured(add_once(docs, text=cleaned), n_special=0)
    vocabulary = tokens.top_vocabulary(docs, F.col("text"), VOCABULARY)
    coded = tokens.encode_text(prepared, F.col("text"), vocabulary, VOCABULARY, cap, add_bos=False)
    return tokens.encoding_report(coded, "source")


# --- batches ------------------------------------------------------------------

def _batched(spark: SparkSession, sf: str) -> DataFrame:
    return batches.length_batches(_encoded(spark, sf), "doc_id", BATCH)


def length_grouped_batches(spark: SparkSession, sf: str) -> DataFrame:
    measured = stage_table(_lengths(spark, sf).select("doc_id", "length"), "lengths")
    return batches.length_batches(measured, "doc_id", BATCH)


def trainer_order(spark: SparkSession, sf: str) -> DataFrame:
    measured = stage_table(_lengths(spark, sf).select("doc_id", "length"), "lengths")
    return batches.trainer_order(measured, "doc_id", BATCH, SEED)


def _padded(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.select(
        *keys, "bucket", "part", "batch", "width", joined(F.col("input_ids")).alias("ids"),
        joined(F.col("attention_mask")).alias("mask"), joined(F.col("labels")).alias("labels"),
    )


def padded_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _padded(batches.padded_rows(_batched(spark, sf)), "doc_id")


def padded_answer_only(spark: SparkSession, sf: str) -> DataFrame:
    batched = batches.length_batches(_encoded_pairs(spark, sf), ["conv_id", "turn"], BATCH)
    return _padded(batches.padded_rows(batched, rebuild_labels=False), "conv_id", "turn")


def padding_efficiency(spark: SparkSession, sf: str) -> DataFrame:
    coded = _encoded(spark, sf).select("doc_id", "input_ids", "length")
    grouped = batches.length_batches(coded, "doc_id", BATCH)
    mixed = batches.length_batches(coded, "doc_id", BATCH, bucket_width=None)
    return batches.padding_efficiency(grouped, "grouped").unionByName(
        batches.padding_efficiency(mixed, "mixed")
    )


def training_batches(docs: DataFrame, key: str, k: int = VOCABULARY, mode: str = "math") -> DataFrame:
    """Raw texts to padded, length-grouped batches, one row per batch.

    The cleaned text is staged once; the cap then reads only the lengths, the
    vocabulary and the encoder only the text.  The encoded rows are staged
    too, because batching counts lengths before it places rows.
    """
    prepared = prompts.prompt_table(docs, mode, keys=[key])
    measured = prepared.withColumn("length", lengths.token_length(F.col("text")))
    staged = stage_table(measured, "prepared")
    cap = lengths.cap_value(staged)
    vocabulary = tokens.top_vocabulary(staged, F.col("text"), k)
    coded = tokens.encode_text(staged.drop("length"), F.col("text"), vocabulary, k, cap)
    encoded = stage_table(tokens.keep_encoded(coded.drop("text")), "encoded")
    return batches.padded_batches(batches.length_batches(encoded, key, BATCH))


def flagship_batches(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    made = training_batches(docs, "doc_id")
    flat = {c: joined(F.flatten(c)).alias(c) for c in ("input_ids", "attention_mask", "labels")}
    return made.select("bucket", "part", "batch", "width", "n_rows", *flat.values())


# --- run plan -----------------------------------------------------------------

def run_plans(spark: SparkSession, sf: str) -> DataFrame:
    docs, lines = table(spark, sf, "documents"), table(spark, sf, "lineitem")

    def counts(df: DataFrame, **columns: str) -> DataFrame:
        """Rows per value of each column, from one scan."""
        kinds = F.array(*[
            F.struct(F.lit(kind).alias("kind"), F.col(c).alias("dataset")) for kind, c in columns.items()])
        return df.select(F.inline(kinds)).groupBy("kind", "dataset").agg(F.count("*").alias("n_rows"))
    every = counts(docs, lang="lang", source="source").unionByName(
        counts(lines, returnflag="l_returnflag", linestatus="l_linestatus"))
    return run_plan(every, epochs=2)


def run_plan_footers(spark: SparkSession, sf: str) -> DataFrame:
    """Plans per language and per source from the footers of files that lie in folders of those names."""
    docs, every = table(spark, sf, "documents").select("doc_id", "lang", "source"), None
    for kind in ("lang", "source"):
        path = new_scratch(spark, f"by-{kind}")
        docs.withColumn("folder", F.col(kind)).write.partitionBy("folder").parquet(path)
        name = F.regexp_extract("file", "/folder=([^/]*)/", 1)
        rows = file_rows(spark, path).groupBy(F.lit(kind).alias("kind"), name.alias("dataset")).agg(F.sum("n_rows").alias("n_rows"))
        every = rows if every is None else every.unionByName(rows)
    return run_plan(every, epochs=2)


def monitor_windows(spark: SparkSession, sf: str) -> DataFrame:
    steps = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("run_name")).agg(
        F.count("*").alias("steps_total")
    )
    window = pm.monitor_window(F.col("steps_total"))
    return steps.select(
        "run_name", "steps_total", window.alias("window"), pm.slope_window(window).alias("slope_window"),
        pm.history_needed(window).alias("history"),
    )


# --- metrics and monitor ------------------------------------------------------

def perplexity(spark: SparkSession, sf: str) -> DataFrame:
    losses = metrics.position_losses(table(spark, sf, "embeddings"), "embedding", "label").withColumn(
        "label", F.col("label").cast("string"))
    return _rounded(metrics.perplexity_with_total(losses, "label", "all"), "eval_loss", "perplexity")


def perplexity_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """The same from scores in four rows of 16 each, as a vocabulary that is too wide for one row comes."""
    chunk = F.explode(F.transform(F.sequence(F.lit(0), F.lit(48), F.lit(16)), lambda i: F.struct(
        i.alias("start"), F.slice("embedding", i + 1, 16).alias("scores"))))
    chunks = table(spark, sf, "embeddings").select("vec_id", "label", chunk.alias("c")).select("vec_id", "label", "c.*")
    losses = metrics.chunk_losses(chunks, ["vec_id"], "start", "scores", "label").withColumn("label", F.col("label").cast("string"))
    return _rounded(metrics.perplexity_with_total(losses, "label", "all"), "eval_loss", "perplexity")


def perplexity_shifted(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    sequence = F.floor(F.col("vec_id") / 16).alias("sequence")  # 16 positions each
    gathered = vectors.groupBy(sequence).agg(
        F.sort_array(F.collect_list(F.struct("vec_id", "embedding", "label"))).alias("_rows")
    ).select("sequence", F.col("_rows.embedding").alias("logits"), F.col("_rows.label").alias("labels"))
    losses = metrics.position_losses(metrics.shifted_positions(gathered, "logits", "labels"), "logits", "label")
    return _rounded(metrics.perplexity(losses, ["sequence"]), "eval_loss", "perplexity")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: steady(F.col(c)) for c in columns})


def _log(spark: SparkSession, sf: str) -> DataFrame:
    """The event log, numbered once; the monitor reads it more than once."""
    return stage_table(monitor.event_log(table(spark, sf, "events")), "log")


def _numbered(spark: SparkSession, sf: str, scale: float = 1.0) -> DataFrame:
    log = monitor.event_log(table(spark, sf, "events")).withColumn("loss", F.col("loss") / scale)
    return monitor.numbered_records(monitor.accepted_records(log))


def _hourly_log(spark: SparkSession, sf: str) -> DataFrame:
    """Hours as steps: several events of a user fall on one step, errors have no loss."""
    hour = F.floor((F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))) / 3600)
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), hour.alias("step"), F.col("event_id").alias("arrival"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"), F.lit(None).cast("double").alias("lr"),
    )


def dedup_steps(spark: SparkSession, sf: str) -> DataFrame:
    records = monitor.numbered_records(monitor.accepted_records(_hourly_log(spark, sf)))
    return records.select("run_id", "step", "n", "loss")


def dedup_ema(spark: SparkSession, sf: str) -> DataFrame:
    """The smoothed loss of a log with repeated steps and missing losses."""
    records = monitor.numbered_records(monitor.accepted_records(_hourly_log(spark, sf)))
    return _rounded(monitor.ema_series(records, TREND).select("run_id", "step", "n", "ema"), "ema")


def dedup_stop(spark: SparkSession, sf: str) -> DataFrame:
    """The stop decision on such a log."""
    return monitor.stop_decisions(_hourly_log(spark, sf), TREND)


def stop_decision_planned(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of different lengths, each judged with the windows, gates and cap of its own plan.

    A run is the events whose type begins with the same letter; all other
    settings are those of call time.
    """
    return monitor.stop_decisions(*_planned(spark, sf))


def _planned(spark: SparkSession, sf: str) -> tuple[DataFrame, monitor.MonitorSettings]:
    events = table(spark, sf, "events").withColumn("user_id", F.ascii("event_type").cast("bigint"))
    log = stage_table(monitor.event_log(events).withColumn("loss", F.col("loss") / PLANNED_SCALE), "log")
    counts = log.groupBy("run_id").agg(F.count("*").alias("n_rows"))
    plan = stage_table(run_plan(counts, accumulate=1, epochs=1), "plan")
    return log, monitor.MonitorSettings.for_runs(plan)


def ema_final(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(monitor.ema_final(_numbered(spark, sf), TREND), "ema")


def ema_series(spark: SparkSession, sf: str) -> DataFrame:
    series = monitor.ema_series(_numbered(spark, sf), TREND)
    return _rounded(series.select("run_id", "n", "ema"), "ema")


def since_best(spark: SparkSession, sf: str) -> DataFrame:
    followed = monitor.best_so_far(monitor.smoothed(_numbered(spark, sf), TREND), TREND)
    return _rounded(followed.select("run_id", "n", "best_ema", "since_best", "cooldown"), "best_ema")


def mad_sigma(spark: SparkSession, sf: str) -> DataFrame:
    trace = monitor.with_windows(monitor.smoothed(_numbered(spark, sf), TREND), TREND, slope=False)
    return _rounded(trace.select("run_id", "n", "sigma"), "sigma")


def ema_slope(spark: SparkSession, sf: str) -> DataFrame:
    trace = monitor.with_windows(monitor.smoothed(_numbered(spark, sf), TREND), TREND, sigma=False)
    return _rounded(trace.select("run_id", "n", "slope"), "slope")


def gate_flags(spark: SparkSession, sf: str) -> DataFrame:
    rising, falling = F.col("step") / 10.0, (70 - F.col("step")) / 60.0
    lr = F.least(rising, F.greatest(falling, F.lit(0.0))) * 0.001
    return monitor.gate_flags(_numbered(spark, sf).withColumn("lr", lr), TREND)


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.trend_flags(monitor.monitor_trace(_numbered(spark, sf, CALM_SCALE), CALM), CALM)


def plateau_worsening(spark: SparkSession, sf: str) -> DataFrame:
    return _flagged(spark, sf).select("run_id", "n", "since_best", "plateau", "worsening")


def monitor_trace(spark: SparkSession, sf: str) -> DataFrame:
    lines = monitor.periodic_summary(_flagged(spark, sf), 5)
    return lines.withColumns({
        c: steady(F.col(c), 6) for c in ("ema", "best_ema", "sigma", "slope")
    })


def stop_decision(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.stop_decisions(_log(spark, sf), TREND)


def stop_decision_calm(spark: SparkSession, sf: str) -> DataFrame:
    scaled = _log(spark, sf).withColumn("loss", F.col("loss") / CALM_SCALE)
    return monitor.stop_decisions(scaled, CALM)


def hard_cap_stop(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.hard_cap_stops(monitor.event_log(table(spark, sf, "events")), TREND)


def stream_convergence(spark: SparkSession, sf: str) -> DataFrame:
    """The event log arriving in four slices of steps, each picked up by a stream.

    Every slice is handled by a new start of the stream from its checkpoint.
    """
    return _streamed(stage_table(_log(spark, sf), "log"), TREND, [0, 20, 40, 60, None])


RECORD_BYTES = 40   # five columns of a log, at most


def _slices(rows: DataFrame, by: str, edges: list, bytes_per_batch: int = BYTES_PER_BATCH) -> Iterator[DataFrame]:
    """Rows from edge to edge.

    The files of a slice that does not fit a micro-batch would be taken in any
    order, and records behind those of an earlier one left out.  So such a
    slice arrives in parts, cut at quantiles.
    """
    for low, high in zip(edges, edges[1:]):
        part = rows.filter(F.col(by) > low)
        part = part if high is None else part.filter(F.col(by) <= high)
        n = -(-part.count() * RECORD_BYTES // bytes_per_batch)
        cuts = part.approxQuantile(by, [i / n for i in range(1, n)], 0.001) if n > 1 else []
        inner = [low, *sorted({int(cut) for cut in cuts}), None]
        for after, last in zip(inner, inner[1:]):
            piece = part.filter(F.col(by) > after)
            yield piece if last is None else piece.filter(F.col(by) <= last)


def _streamed(log: DataFrame, settings: monitor.MonitorSettings, edges: list, **options) -> DataFrame:
    """The stops of a log that arrives in slices of steps, and of what waits at its end."""
    spark = log.sparkSession
    source, sink, checkpoint = (new_scratch(spark, f"stops-{p}") for p in ("in", "out", "state"))
    for part in _slices(log, "step", edges, options.get("bytes_per_batch", BYTES_PER_BATCH)):
        part.write.mode("append").parquet(source)
        follow_folder(spark, source, sink, checkpoint, settings, **options)
    return spark.read.parquet(sink).select("run_id", "stop_step", "reason")


def stream_convergence_planned(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of different lengths, each with the settings of its own plan, arriving in two slices; long runs go by blocks."""
    log, settings = _planned(spark, sf)
    return _streamed(log, settings, [0, 150, None], hot_rows=500)


def stream_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """The event log with records up to ten steps late: those that wait are handled in order, at the end too.

    Records come by ``step`` plus a number below ten that follows from their arrival.
    """
    log = stage_table(_log(spark, sf).withColumn("due", F.col("step") + F.pmod(F.col("arrival") * 7, F.lit(10))), "log")
    source, sink, checkpoint = (new_scratch(spark, f"late-{p}") for p in ("in", "out", "state"))
    for part in _slices(log, "due", [0, 35, 1 << 60]):
        part.drop("due").write.mode("append").parquet(source)
        follow_folder(spark, source, sink, checkpoint, TREND, delay=10)
    stops = spark.read.parquet(sink).select("run_id", "stop_step", "reason")
    return stops.unionByName(closing_stops(spark, checkpoint, TREND))


def _drawn_images(docs: DataFrame) -> DataFrame:
    """A small image of each document's bytes: bitmap, GIF or WEBP by its number; some are cut off, some claim too much."""
    ink = F.substring(F.concat(F.encode(F.coalesce("text", F.lit("")), "utf-8"), F.lit(bytearray(96))), 1, 96)
    more = F.when(F.col("doc_id") % 5 == 1, F.lit("04")).otherwise("02")

    def raw(*parts):
        return F.concat(*[F.unhex(F.lit(p)) if isinstance(p, str) else p for p in parts])
    bitmap = raw("424D96000000000000003600000028000000", "10000000", F.unhex(more), "000000", "010018000000000060000000",
                 "00" * 16, ink)
    size = F.unhex(F.when(F.col("doc_id") % 5 == 1, F.lit("62")).otherwise("60"))
    gif = raw("474946383961", "0200020000" "0000", "2C0000000002000200" "00" "02", size, ink, "00", "3B")
    riff = raw("52494646", F.unhex(F.when(F.col("doc_id") % 5 == 1, F.lit("6F")).otherwise("6D")), "000000", "57454250",
               "5650384C", "61000000", "2F", ink)
    image = F.when(F.col("doc_id") % 3 == 0, bitmap).when(F.col("doc_id") % 3 == 1, gif).otherwise(riff)
    cut = F.length(image) - F.when(F.col("doc_id") % 5 == 0, 1 + F.col("doc_id") % 7).otherwise(0)
    return docs.select("doc_id", F.substring(image, F.lit(1), cut.cast("int")).alias("image"))


def image_states(spark: SparkSession, sf: str) -> DataFrame:
    drawn = _drawn_images(table(spark, sf, "documents").select("doc_id", "text"))
    found = images.image_states(drawn)
    return found.select("doc_id", "format", F.col("problem").isNull().alias("sound"))


QUERIES = {
    "sft_pairs": pairs,
    "sft_prompt": sft_prompt,
    "nonempty_filter": nonempty_filter,
    "clean_math": clean_documents("math"),
    "clean_latex": clean_documents("latex"),
    "clean_code": clean_documents("code"),
    "clean_other": clean_documents("other"),
    "clean_pages": clean_pages,
    "strip_tags_pages": strip_tags_pages,
    "denylist_hits": denylist_hits,
    "catalog_detect_mode": catalog_detect_mode,
    "catalog_role_map": catalog_role_map,
    "ledger_new_sources": ledger_new_sources,
    "seeded_shuffle_key": seeded_shuffle_key,
    "prompt_preview": prompt_preview,
    "chat_render": chat_render,
    "causal_text": causal_text,
    "instruction_template": instruction_template,
    "multimodal_text": multimodal_text,
    "vision_prompt": vision_prompt,
    "retention_report": retention_report,
    "token_length": token_length,
    "length_percentiles": length_percentiles,
    "auto_max_length": auto_max_length,
    "vocab_topk": vocab_topk,
    "tokenize_truncate": tokenize_truncate,
    "causal_labels": causal_labels,
    "answer_only_labels": answer_only_labels,
    "nonempty_ids": nonempty_ids,
    "tokenized_export": tokenized_export,
    "export_resumed": export_resumed,
    "length_grouped_batches": length_grouped_batches,
    "padded_batches": padded_batches,
    "padded_answer_only": padded_answer_only,
    "padding_efficiency": padding_efficiency,
    "flagship_batches": flagship_batches,
    "run_plan": run_plans,
    "run_plan_footers": run_plan_footers,
    "monitor_windows": monitor_windows,
    "perplexity": perplexity,
    "perplexity_shifted": perplexity_shifted,
    "perplexity_chunked": perplexity_chunked,
    "trainer_order": trainer_order,
    "image_states": image_states,
    "dedup_steps": dedup_steps,
    "dedup_ema": dedup_ema,
    "dedup_stop": dedup_stop,
    "ema_final": ema_final,
    "ema_series": ema_series,
    "since_best": since_best,
    "mad_sigma": mad_sigma,
    "ema_slope": ema_slope,
    "gate_flags": gate_flags,
    "plateau_worsening": plateau_worsening,
    "monitor_trace": monitor_trace,
    "stop_decision": stop_decision,
    "stop_decision_calm": stop_decision_calm,
    "stop_decision_planned": stop_decision_planned,
    "hard_cap_stop": hard_cap_stop,
    "stream_convergence": stream_convergence,
    "stream_convergence_planned": stream_convergence_planned,
    "stream_out_of_order": stream_out_of_order,
}
