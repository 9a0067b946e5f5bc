from collections import Counter

import numpy as np
import pytest

from corpusloom.llm import quality_trees as qt

DOCS = "doc_id bigint, text string"
TEXTS = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "a b c d e f a b c d e", "x " * 50, "é# $é\n\ny z\ny z\n \ny z",
    "    word", " ".join(str(i % 97) for i in range(500)), "l\r\nl\r\nl", "<a> & | % * #",
]


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered))


@pytest.mark.parametrize("text", TEXTS)
def test_statistics(text):
    assert qt.text_stats(text)[:5] == brute(text)


@pytest.mark.parametrize("words", ["ПРИВЕТ МИР ", "ΑΘΗΝΑ Σ ", "Été À Paris ", "LOUD AND CLEAR ", "Ⅳ Ⓐ ǅ 漢字 "])
def test_capitals_are_the_same_in_short_and_long_texts(words):
    at = len(qt.STATS) + qt.EXTRA.index("n_upper")
    each = sum(c.isupper() for c in words)
    for times in (1, 199 // len(words), 200 // len(words) + 1, 500):
        assert qt.text_stats(words * times)[at] == each * times


def test_many_different_words():
    words = [str(i).encode() for i in range(9000)] * 2
    assert qt.repeat_words(words) == 18000


def test_scores_are_monotonic_and_learned():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.normal(size=3000)) > 0.6).astype(float)
    forest = qt.fit_forest(x, y, [1, 0, -1])
    grid = rng.random((200, 3))
    for feature, sign in ((0, 1), (2, -1)):
        steps = np.linspace(0, 1, 40)
        moved = np.stack([forest.raw(np.where(np.arange(3) == feature, s, grid)) for s in steps])
        assert (sign * np.diff(moved, axis=0) >= -1e-12).all()
    assert ((forest.score(x) > 0.5) == (y > 0.5)).mean() > 0.85


@pytest.mark.parametrize("labels", [[], [1.0, 1.0]])
def test_one_class_gives_a_constant(labels):
    forest = qt.fit_forest(np.zeros((len(labels), 2)), np.array(labels), [0, 0])
    assert set(forest.score(np.zeros((3, 2)))) == {(sum(labels) + 1) / (len(labels) + 2)}


def test_rows_of_every_kind(spark):
    good = "this text has quite enough different words to pass the base rule of the operator"
    rows = [(i, t, 1, "a") for i, t in enumerate(TEXTS)] + [(None, good, 1, "b"), (50, good, 1, "c"), (50, good, 1, "c")]
    docs = spark.createDataFrame(rows, DOCS + ", n_words int, kept string")
    labels = spark.createDataFrame([(50, 1), (50, 1), (3, 0), (4, None), (None, 0), (999, 1)], "doc_id bigint, quality int")
    got = qt.quality_verdicts(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        words, repeats = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (words < 10 or 100 * repeats > 20 * words)
        assert not (r["kept"] and r["base_failed"]) and 0 <= r["score"] <= 1
    kept = qt.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in got if r["kept"])


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert qt.quality_verdicts(docs, labels).count() == qt.keep_good(docs, labels).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = qt.quality_verdicts(docs, labels.filter("doc_id % 4 <> 2"))
    held = judged.join(labels.filter("doc_id % 4 = 2"), "doc_id").toPandas()
    assert ((held["kept"] == (held["quality"] == 1)).mean()) > 0.9


def walk(forest, row):
    """Every tree followed node by node for one row."""
    total = forest.base
    for node in forest.roots:
        while forest.left[node] != node:
            node = forest.left[node] if row[forest.feature[node]] <= forest.edge[node] else forest.right[node]
        total += forest.value[node]
    return total


def test_node_arrays_equal_a_walk():
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((500, 4)), 1)
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(0, 0.3, 500) > 0.4).astype(float)
    forest = qt.fit_forest(x, y, [1, 0, 0, -1], trees=12, depth=3)
    assert np.allclose(forest.raw(x), [walk(forest, row) for row in x], rtol=1e-12)
    for f, sign in ((0, 1), (3, -1)):
        for row in x[:40]:
            line = np.repeat(row[None], 60, axis=0)
            line[:, f] = np.linspace(-4, 4, 60)
            assert (np.diff(forest.raw(line)) * sign >= -1e-12).all()


def test_first_split_is_the_best_of_all():
    """The root of the first tree, against every feature and edge tried one by one."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 6, (300, 3)).astype(float)
    y = ((x[:, 1] > 2) ^ (rng.random(300) < 0.1)).astype(float)
    forest = qt.fit_forest(x, y, [0, 0, 0], trees=1, depth=1)
    share = (y.sum() + 1) / 302
    grad, weight = y - share, np.full(300, share * (1 - share))

    def part(mask):
        return grad[mask].sum() ** 2 / (weight[mask].sum() + 1.0)
    tried = {(f, e): part(x[:, f] <= e) + part(x[:, f] > e) for f in range(3) for e in range(6)
             if min(weight[x[:, f] <= e].sum(), weight[x[:, f] > e].sum()) >= 3.0}
    best = max(tried, key=tried.get)
    root = forest.roots[0]
    assert forest.feature[root] == best[0]
    assert ((x[:, best[0]] <= forest.edge[root]) == (x[:, best[0]] <= best[1])).all()
