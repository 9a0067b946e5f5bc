import math
import random
from collections import Counter

import pytest

from corpusloom.llm import backoff_lm as lm

DOCS = "doc_id bigint, text string"


def brute(texts, backoff=0.4, least=2):
    split = [(t or "").encode().lower().split() for t in texts]
    single = Counter(w for ws in split for w in ws)
    pairs = Counter(p for ws in split for p in zip(ws, ws[1:]))
    total, made = sum(single.values()), []
    for ws in split:
        score, seen = 0.0, 0
        for i, w in enumerate(ws):
            if i and pairs[ws[i - 1], w] >= least:
                score, seen = score + math.log10(pairs[ws[i - 1], w] / single[ws[i - 1]]), seen + 1
            else:
                score += math.log10(single[w] / total) + (math.log10(backoff) if i else 0)
        made.append((len(ws), seen, score))
    return made


@pytest.mark.parametrize("chunk_words,buckets", [(40, 7), (1_000_000, 1)])
def test_equals_brute_force(spark, chunk_words, buckets):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "The", "the", "é", "zz", "q\tr"], k=rng.randrange(30))) for _ in range(120)]
    texts += [None, "", " \n ", "lonely", "a b", "a b", "the " * 20000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], DOCS + ", chunk int")
    got = {r["doc_id"]: r for r in lm.backoff_scores(docs, chunk_words=chunk_words, buckets=buckets).collect()}
    for i, (n, seen, score) in enumerate(brute(texts)):
        assert (got[i]["n_words"], got[i]["n_seen"]) == (n, seen)
        assert got[i]["log10_sum"] == pytest.approx(score, abs=1e-6)


def test_null_keys_and_repeats(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (None, None)], DOCS)
    rows = sorted((str(r["doc_id"]), r["n_words"], round(r["log10_sum"], 9)) for r in lm.backoff_scores(docs).collect())
    assert rows == sorted([("1", 2, round(math.log10(0.5), 9))] * 2 + [("None", 0, 0.0), ("None", 2, round(math.log10(0.5), 9))])


def test_no_rows(spark):
    assert lm.backoff_scores(spark.createDataFrame([], DOCS)).count() == 0
