import random
import re
from itertools import permutations

import numpy as np
import pytest

from corpusloom.llm import filter_audit, transducer
from corpusloom.llm.registry import quality_marks

DOCS = "doc_id bigint, text string, source string"


def brute_counts(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text)
    plain = text.decode()
    return [len(words), len(set(words)), len(re.findall("[A-Z]", plain)), len(plain), len(re.findall(r"[#$%&*|]", plain))]


def some_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "B", "word", "Word", "naïve", "日本語", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "#tag", "100%", "ÀÉ", " ",
             " ", "emoji😀", "aaaaaaab", "aaaaaaac"]
    gaps = [" ", "  ", "\n", "\t", "\x0b", "\x0c", "\r\n"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60))).encode() for _ in range(n)] + [
        b"", b" ", b"\n\n", b"one", b" one", b"one ", "é".encode(), b"x" * 5000, b"ab " * 700]


@pytest.mark.parametrize("block", [1, 7, 64, 1000, 1 << 20])
def test_counts_equal_plain_ones(block):
    texts = some_texts(block)
    got = transducer.text_counts(texts, block=block)
    assert got.tolist() == [brute_counts(t) for t in texts]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(transducer, "mixed", lambda values: np.zeros_like(values))
    texts = some_texts(3)
    assert transducer.text_counts(texts).tolist() == [brute_counts(t) for t in texts]


def brute_audit(rows, good=(), toxic=()):
    """Every order walked through document by document."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))

    def fails(i, text):
        words, distinct, capitals, chars, symbols = brute_counts((text or "").encode())
        found = {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * chars, "D": symbols > 0,
                 "E": i is not None and i > first[text or ""]}
        return {name for name, failed in found.items() if failed}
    docs = [(part or "", i, fails(i, text)) for i, text, part in rows]
    out, shapley = {}, {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            for step, name in enumerate(order, 1):
                removed = [d for d in left if name in d[2]]
                left = [d for d in left if name not in d[2]]
                of_part = [d for d in docs if d[0] == part]
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(name in d[2] for d in of_part) - len(removed),
                    sum(d[2] == {name} for d in of_part), sum(d[1] in good for d in removed), sum(d[1] in toxic for d in removed)]
                shapley[part, name] = shapley.get((part, name), 0) + len(removed)
    return {key: [*row, shapley[key[0], key[1][key[2] - 1]]] for key, row in out.items()}


def test_equals_a_walk_through_every_order(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.choice([20, 60, 80]))) for _ in range(12)]
    texts += ["LOUD " * 60, "a # b", None, "", " ".join(f"Word{i} & {i}" for i in range(70))]
    rows = [(i, rng.choice(texts), rng.choice(["s", "s", "s", "t", None, ""])) for i in range(150)]
    rows += [rows[4], (None, texts[0], "s"), (None, None, None), (900, "Unique " * 30000, "long")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(120)] + [
        (3, 1, 0), (3, 0, 1), (None, 1, 1), (5000, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", n_words int, fails string")
    marks = quality_marks(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = filter_audit.filter_audit(docs, marks).collect()
    want = brute_audit(rows, {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None})
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in got} == want
    assert len(got) == len(want)


def test_other_rules_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, "a", "s"), (3, "", "s")], DOCS)
    got = filter_audit.filter_audit(docs, rules={"S": "n_words < 2", "T": "n_words < 1"}).collect()
    assert {(r["filter_order"], r["step"]): (r["removed"], r["redundant"], r["shapley"]) for r in got} == {
        ("ST", 1): (2, 0, 3), ("ST", 2): (0, 1, 1), ("TS", 1): (1, 0, 1), ("TS", 2): (1, 1, 3)}


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert filter_audit.filter_audit(empty).count() == 0
