import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.labels import answer_only
from corpusloom.functions.text import words
from corpusloom.operators import batches, lengths, tokens
from corpusloom.plans.queries import training_batches
from corpusloom.session import new_scratch
from corpusloom.sources.export import write_tokens

TEXTS = ["the cat sat", "the the dog", "", "a\tb \n the\u00a0cat", " ".join(f"w{i % 7}" for i in range(50))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def vocabulary(k):
    counts = Counter(w for t in TEXTS for w in t.split())
    ranked = sorted(counts, key=lambda w: (-counts[w], w))[:k]
    return {w: i + len(tokens.RESERVED) for i, w in enumerate(ranked)}


@pytest.mark.parametrize("k,cap", [(3, 5), (100, 1000), (5, 1)])
def test_encode_equals_a_dictionary_lookup(docs, k, cap):
    known = vocabulary(k)
    vocab = tokens.top_vocabulary(docs, F.col("text"), k)
    assert {r.token: r.id for r in vocab.collect()} == known
    for row in tokens.encode(docs, words(F.col("text")), vocab, k, cap).collect():
        split = TEXTS[row.doc_id].split()
        want = ([tokens.BOS] + [known.get(w, tokens.UNK) for w in split])[:cap]
        assert row.input_ids == row.labels == want
        assert row.attention_mask == [1] * len(want)
        assert row.length == len(split) + 1


def test_reserved_tokens_have_fixed_ids(spark):
    row = spark.createDataFrame([("<|user|> hi<|end|> <|assistant|>",)], "text string")
    vocab = tokens.top_vocabulary(row, F.lit("hi hi"), 4)
    out = tokens.encode(row, words(tokens.split_marks(F.col("text"))), vocab, 4, 10, add_bos=False).first()
    assert out.input_ids == [4, 8, 6, tokens.ASSISTANT_ID]


def test_pad_token_falls_back():
    assert tokens.pad_token(None, 5, 7) == 5 and tokens.pad_token(None, None, 7) == 7
    assert tokens.pad_token(0, 5, 7) == 0 and tokens.pad_token(None, None, None) is None


@pytest.mark.parametrize("ids,want", [
    ([1, 7, 2, 3], [-100, -100, 2, 3]), ([7, 1, 7, 2], [-100, -100, -100, 2]), ([1, 2], [1, 2]),
    ([1, 7], [-100, -100]), ([], []), ([7], [-100]),
])
def test_answer_only_labels(spark, ids, want):
    row = spark.createDataFrame([(ids,)], "ids array<bigint>")
    assert row.select(answer_only(F.col("ids"), 7)).first()[0] == want


def test_percentiles_are_linear_and_cut(spark):
    values = [3, 9, 20, 21, 400, 7, 7]
    rows = spark.createDataFrame([(v,) for v in values], "length int")
    got = lengths.length_cap(rows).first()
    want = [int(np.percentile(values, p)) for p in (50, 95, 99)]
    assert [got.p50, got.p95, got.p99] == want and got.n_rows == len(values)
    assert got.max_length == want[1]


@pytest.mark.parametrize("length,cap", [(127, 128), (128, 128), (129, 129), (1023, 1023), (1024, 1024), (1025, 1024)])
def test_cap_bounds(spark, length, cap):
    rows = spark.createDataFrame([(length,)], "length int")
    assert lengths.length_cap(rows).first().max_length == cap
    assert spark.range(1).select(lengths.cap_value(rows)).first()[0] == cap


def test_no_rows_is_an_error(spark):
    with pytest.raises(Exception, match="no rows to measure"):
        lengths.length_cap(spark.createDataFrame([], "length int")).collect()


@pytest.fixture(scope="module")
def coded(spark):
    """300 rows, two thirds of them of one length: a hot bucket."""
    rows = [(i, [1] * (10 if i % 3 else 5 + i), 10 if i % 3 else 5 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, input_ids array<bigint>, length int")
    return df.withColumns({
        "attention_mask": F.transform("input_ids", lambda _: F.lit(1).cast("bigint")), "labels": F.col("input_ids"),
    })


@pytest.mark.parametrize("width,part_rows", [(64, 65536), (64, 50), (None, 50)])
def test_every_row_is_in_one_batch(coded, width, part_rows):
    made = batches.length_batches(coded, "id", 8, bucket_width=width, part_rows=part_rows)
    rows = made.select("id", "length", *batches.BATCH_KEYS, "slot").collect()
    assert sorted(r.id for r in rows) == list(range(300))
    groups = Counter(tuple(r[k] for k in batches.BATCH_KEYS) for r in rows)
    assert max(groups.values()) <= 8
    assert len({(r.bucket, r.part, r.batch, r.slot) for r in rows}) == 300
    if width:
        assert all(r.bucket == r.length // width for r in rows)
    if part_rows == 50:
        largest = Counter((r.bucket, r.part) for r in rows).most_common(1)[0][1]
        assert largest < 120  # the hot bucket has more than 200 rows
    short = sum(1 for n in groups.values() if n < 8)
    assert short <= len({(r.bucket, r.part) for r in rows})


def test_padding(coded):
    batched = batches.length_batches(coded, "id", 8)
    rows = batches.padded_rows(batched.withColumn("labels", F.transform("labels", lambda x: x * 0 - 5)), 9, False).collect()
    widths = {}
    for r in rows:
        widths.setdefault((r.bucket, r.part, r.batch), []).append(r)
    for group in widths.values():
        width = math.ceil(max(r.n_tokens for r in group) / 8) * 8
        for r in group:
            assert len(r.input_ids) == len(r.attention_mask) == len(r.labels) == r.width == width
            gap = width - r.n_tokens
            assert r.input_ids[r.n_tokens:] == [9] * gap and r.attention_mask[r.n_tokens:] == [0] * gap
            assert r.labels == [-5] * r.n_tokens + [-100] * gap


def test_batch_rows_hold_the_same_as_row_form(coded):
    batched = batches.length_batches(coded, "id", 8)
    whole = batches.padded_batches(batched).collect()
    assert sum(r.n_rows for r in whole) == 300
    for r in whole:
        assert {len(x) for x in r.input_ids + r.attention_mask + r.labels} == {r.width}
        for ids, mask, labels in zip(r.input_ids, r.attention_mask, r.labels):
            assert labels == [i if m else -100 for i, m in zip(ids, mask)]
    grouped = batches.padding_efficiency(batched, "g").first()
    mixed = batches.padding_efficiency(batches.length_batches(coded, "id", 8, bucket_width=None), "m").first()
    assert grouped.real_tokens == mixed.real_tokens and grouped.efficiency > mixed.efficiency


def test_export_types_and_drops(spark, docs):
    vocab = tokens.top_vocabulary(docs, F.col("text"), 10)
    out = tokens.encode(docs, words(F.col("text")), vocab, 10, 16, add_bos=False)
    assert tokens.keep_encoded(out).count() == 4
    assert tokens.encoding_report(out, "doc_id").filter("n_dropped = 1").count() == 1
    path = new_scratch(spark, "test")
    write_tokens(out.withColumn("input_ids", F.col("input_ids").cast("array<int>")), path)
    kinds = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema.fields}
    assert kinds["input_ids"] == kinds["labels"] == "array<bigint>" and kinds["length"] == "int"


def test_many_part_keys_are_one_row_key(coded):
    two = coded.select(F.floor(F.col("id") / 10).alias("a"), (F.col("id") % 10).alias("b"), "input_ids", "length")
    rows = batches.length_batches(two, ["a", "b"], 8, part_rows=50).collect()
    assert len({(r.bucket, r.part, r.batch, r.slot) for r in rows}) == 300


def test_vocabulary_size_is_bounded(spark, docs):
    vocab = tokens.top_vocabulary(docs, F.col("text"), 10)
    with pytest.raises(ValueError, match="k must lie"):
        tokens.encode(docs, words(F.col("text")), vocab, tokens.MOST_TOKENS + 1, 16)


def test_total_from_the_same_counts(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 9), ("b", 400), (None, 7)], "lang string, length int")
    got = lengths.length_cap(lengths.counted_lengths(rows, "lang", "all"), ["lang"], weight=F.col("_rows"))
    by = {r.lang: (r.n_rows, r.p50) for r in got.collect()}
    assert by == {"a": (2, 6), "b": (1, 400), None: (1, 7), "all": (4, 8)}


@pytest.mark.parametrize("n,batch,levels", [(700, 4, (2, 5)), (37, 8, (1,)), (5, 8, (2, 5)), (1, 1, (2, 5)), (400, 1, (1, 2, 3))])
def test_trainer_order(spark, n, batch, levels):
    import hashlib
    rows = [(i, (i * 7919) % 23 + (50 if i in (n // 2, n // 3) else 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, length long")
    got = {r.position: (r.doc_id, r.batch) for r in batches.trainer_order(df, "doc_id", batch, 7, levels=levels).collect()}
    order = sorted(rows, key=lambda r: (hashlib.md5(f"7:{r[0]}".encode()).hexdigest(), r[0]))
    size = max(1, min(n // (batch * 4), 50)) * batch
    groups = [sorted(order[at:at + size], key=lambda r: -r[1]) for at in range(0, n, size)]
    tops = [g[0][1] for g in groups]
    top = tops.index(max(tops))
    groups[0][0], groups[top][0] = groups[top][0], groups[0][0]
    assert [got[i] for i in range(n)] == [(r[0], i // batch) for i, r in enumerate(r for g in groups for r in g)]


def test_trainer_order_of_no_rows(spark):
    assert batches.trainer_order(spark.createDataFrame([], "doc_id long, length long"), "doc_id", 4, 7).count() == 0


@pytest.mark.parametrize("k,cap,add_bos", [(3, 5, True), (100, 1000, True), (5, 1, True), (5, 0, True), (4, 3, False), (0, 9, False)])
def test_texts_are_encoded_as_their_words(spark, k, cap, add_bos):
    rows = spark.createDataFrame([*enumerate(TEXTS), (90, None), (91, "<|user|> the"), (92, " \u2028\x1c ")], "doc_id long, text string")
    vocab = tokens.top_vocabulary(rows, F.col("text"), k)
    want = tokens.encode(rows, words(F.col("text")), vocab, k, cap, add_bos)
    made = tokens.encode_text(rows, F.col("text"), vocab, k, cap, add_bos)
    assert made.schema.simpleString() == want.schema.simpleString()
    assert sorted(made.collect(), key=lambda r: r.doc_id) == sorted(want.collect(), key=lambda r: r.doc_id)
    assert tokens.keep_encoded(made).count() == tokens.keep_encoded(want).count()


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([(bytearray(b"a \xff\xfe b \xff\xfe"),)], "raw binary").select(F.col("raw").cast("string").alias("text"))
    vocab = tokens.top_vocabulary(rows, F.col("text"), 9)
    assert {r.token: r.n for r in vocab.collect()} == {"a": 1, "b": 1, "\ufffd\ufffd": 2}
    ids = tokens.encode_text(rows, F.col("text"), vocab, 9, 99).first()
    assert ids.length == 5 == rows.select(lengths.token_length(F.col("text"))).first()[0] and tokens.UNK not in ids.input_ids


def test_counts_that_are_passed_on_add_up(spark, docs, monkeypatch):
    import pyarrow as pa

    from corpusloom.functions import word_lists
    monkeypatch.setattr(word_lists, "MOST_COUNTED", 2)
    found, batch = Counter(), pa.RecordBatch.from_arrays([pa.array([*TEXTS, None])], ["text"])
    passed = list(word_lists.count_tokens(iter([batch, batch])))
    for part in passed:
        for row in part.to_pylist():
            found[row["token"]] += row["n"]
    assert len(passed) > 2 and found == Counter({w: 2 * n for w, n in Counter(w for t in TEXTS for w in t.split()).items()})


@pytest.mark.parametrize("name", ["causal_labels", "tokenized_export", "padded_batches", "padding_efficiency"])
def test_no_word_is_handled_row_by_row(spark, name, monkeypatch, tmp_path):
    """Splitting, counting and lookup in Spark's lambdas took most of the time of these queries."""
    from corpusloom.plans import queries
    docs = spark.createDataFrame([(i, TEXTS[i % 5], "en", "s") for i in range(40)], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    plans, stage = [], queries.stage_table

    def staged(df, kind):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, kind)
    monkeypatch.setattr(queries, "stage_table", staged)
    queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(plans) == 2 and not any("lambdafunction" in p or "split(" in p for p in plans)
