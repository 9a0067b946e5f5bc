"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text, keep_nonblank
from corpusloom.operators import batches, monitor, prompts, roles, tokens
from corpusloom.plans import queries as q

SF = "/root/testdata/sf0.001"
PYTHON = {
    "dedup_stop", "image_states", "mad_sigma", "monitor_trace", "plateau_worsening", "stop_decision", "stop_decision_calm", "stop_decision_planned", "stream_convergence",
}


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: physical(query(spark, SF)) for name, query in q.QUERIES.items() if not name.startswith("stream_")}


def test_python_only_where_it_must_be(plans):
    with_python = {n for n, p in plans.items() if re.search(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroups", p)}
    assert with_python <= PYTHON


def test_no_cross_products(plans):
    assert not [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoopJoin" in p]


def test_windows_are_partitioned(plans):
    """Only the vocabulary's rank, over at most k rows, has no partition key."""
    for name, plan in plans.items():
        for specification in re.findall(r"windowspecdefinition\((.*)", plan):
            first = specification.split(",")[0]
            if " ASC " in first or " DESC " in first:
                assert "TakeOrderedAndProject" in plan and first.startswith("n#"), name


@pytest.mark.parametrize("mode", ("math", "latex", "code", "other"))
def test_each_pattern_is_evaluated_once(spark, mode):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chain = clean_text(F.col("text"), mode)
    alone = optimized(docs.select(chain.alias("text"))).count("regexp_replace")
    kept = keep_nonblank(docs.select("doc_id", "text"), chain)
    assert optimized(kept.filter("length(text) > 3")).count("regexp_replace") == alone


def test_scans_read_only_what_is_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = physical(prompts.prompt_table(docs, keys=["doc_id"]))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    report = physical(batches.length_batches(docs.select("doc_id", F.col("n_chars").alias("length")), "doc_id", 8))
    assert "text" not in "".join(re.findall(r"ReadSchema: \S+", report))


def test_borrowed_turns_come_from_a_filtered_scan(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert "GreaterThanOrEqual(turn,1024)" in physical(prompts.question_answer_pairs(turns))


def test_the_cap_filters_the_log_scan(spark):
    log = q._log(spark, SF)
    s = monitor.MonitorSettings(hard_cap_step=57)
    plan = physical(monitor.stop_decisions(log, s))
    assert "LessThan(step,57)" in plan and "GreaterThanOrEqual(step,57)" in plan


def test_encoding_needs_no_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    vocab = tokens.top_vocabulary(docs, F.col("text"), 50)
    main = physical(tokens.encode(docs, F.split("text", " "), vocab, 50, 64))
    rows_only = [line for line in main.splitlines() if not re.match(r"^\s*:", line)]
    assert not any("Exchange" in line for line in rows_only)
    # The lookup is a value inside the expression, not a column that every row carries.
    assert not any("AS _lookup" in line for line in rows_only)


def test_alias_lookup_is_broadcast(spark):
    catalog = roles.column_catalog(spark, {"d": spark.read.parquet(f"{SF}/documents.parquet")})
    assert "BroadcastHashJoin" in physical(roles.map_roles(catalog))
