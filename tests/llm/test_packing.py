import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import packing as pk
from corpusloom.llm.registry import vocabulary_text

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def vocabulary():
    return vocabulary_text()


def brute_ids(vocabulary, text):
    return Tokenizer.from_str(vocabulary).encode(text or "", add_special_tokens=False).ids + [1]


ODD = [
    "", None, " \n\t ", "The end, the End. THE END", "İstanbul's 'ser 12ab ÀÉ é Σίσυφος ΣΑΣ", "a\x1cb\x85c d",
    "<|endoftext|> x<|startoftext|>y", "it's, we'll. ́ combining", "....,,,. a.b,c", "word " * 5000, "🙂 漢字 한국어",
]


def test_word_by_word_ids_equal_whole_text_ids(vocabulary, monkeypatch):
    monkeypatch.setattr(pk, "CACHE_WORDS", 3)
    coder = pk.WordCoder(vocabulary)
    for texts in (ODD, ODD[::-1], [], [""]):
        got = coder.encode([t or "" for t in texts])
        assert [g.tolist() for g in got] == [brute_ids(vocabulary, t) for t in texts]


def test_plan_uses_each_piece_once_and_fills_well():
    rng = np.random.default_rng(1)
    for n in (0, 1, 40, 20_000):
        lengths = np.minimum(rng.lognormal(3.0, 1.0, n).astype(int) + 1, 256)
        counts = np.bincount(lengths, minlength=257)
        plan = pk.packing_plan(counts, 256)
        used = np.zeros(257, int)
        for combo, times in plan:
            assert sum(combo) <= 256 and times > 0
            np.add.at(used, list(combo), times)
        assert (used == counts).all()
        if n == 20_000:
            assert lengths.sum() / (256 * sum(t for _, t in plan)) > 0.99


def test_least_squares_finds_an_exact_mix():
    counts = np.zeros(11, int)
    counts[[7, 3, 5]] = 600, 600, 400
    plan, rest = pk.least_squares_plan(counts, 10)
    assert rest.sum() <= 12
    assert dict(plan)[(7, 3)] >= 595 and dict(plan)[(5, 5)] >= 195


def uses(plan, total, size):
    used = np.zeros(size, int)
    for combo, times in plan:
        assert sum(combo) <= total and times > 0 and list(combo) == sorted(combo, reverse=True)
        np.add.at(used, list(combo), [times] * len(combo))
    return used


@pytest.mark.parametrize("class_width", [1, 8])
@pytest.mark.parametrize("kind", ["empty", "nine", "short", "mixed", "whole", "long and empty", "none", "one"])
def test_short_pieces_fill_exactly(class_width, kind):
    rng = np.random.default_rng(7)
    lengths = {
        "empty": np.ones(20_000, int), "nine": np.full(5_000, 9), "short": rng.integers(1, 11, 30_000),
        "mixed": np.minimum(rng.lognormal(5.0, 1.5, 20_000).astype(int) + 1, 2048), "whole": np.full(50, 2048),
        "long and empty": np.concatenate([np.full(3_000, 1500), np.ones(1_644_000, int)]), "none": np.empty(0, int),
        "one": np.array([3])}[kind]
    counts = np.bincount(lengths, minlength=2049)
    plan = pk.packing_plan(counts, 2048, class_width=class_width) if kind != "mixed" or class_width > 1 else []
    if plan:
        assert (uses(plan, 2048, 2049) == counts).all()
    sequences = sum(times for _, times in plan)
    least = -(-int(lengths.sum()) // 2048)
    if kind in ("empty", "nine", "short", "whole", "one"):
        assert sequences <= least + (least > 5) + 24 * (kind == "nine")  # 227 pieces of nine leave five tokens
    elif plan:
        assert lengths.sum() / (2048 * sequences) > 0.99
    if kind == "empty":
        assert sequences == 10


def test_empty_texts_share_sequences(spark, vocabulary):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 2 = 0, '', cast(null as string)) as text")
    rows = pk.pack_documents(docs, vocabulary)
    assert rows.agg({"sequence_id": "max"}).first()[0] == 9
    assert rows.select("sequence_id", "offset").distinct().count() == 20_000


def test_combinations():
    assert set(pk.shallow_combinations(np.array([1, 2, 3, 4, 6]), 6, 3)) == {
        (6,), (4, 2), (4, 1, 1), (3, 3), (3, 2, 1), (2, 2, 2)}


def check_pieces(vocabulary, rows, texts, width):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids, at = np.array(brute_ids(vocabulary, text), "<u4"), 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= width
    return sum(r["length"] for r in rows) / (width * len(by_sequence))


def test_packed_documents(spark, vocabulary):
    texts = dict(enumerate(ODD + ["some words of text here " * (i % 41) for i in range(300)]))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in texts.items()], DOCS + ", start int, class string")
    rows = pk.pack_documents(docs.repartition(5), vocabulary, width=64, class_width=4).collect()
    assert check_pieces(vocabulary, rows, texts, 64) > 0.95


def test_repeated_rows_null_keys_and_none(spark, vocabulary):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], DOCS)
    rows = pk.pack_documents(docs, vocabulary, width=16, class_width=8).collect()
    assert sorted((str(r["doc_id"]), r["length"]) for r in rows) == [("1", 3), ("1", 3), ("None", 1), ("None", 2)]
    assert sorted(r["offset"] for r in rows) == [0, 3, 6, 8] or len({r["sequence_id"] for r in rows}) > 1
    assert pk.pack_documents(spark.createDataFrame([], DOCS), vocabulary).count() == 0
    with pytest.raises(ValueError):
        pk.pack_documents(docs, vocabulary, width=20, class_width=8)
