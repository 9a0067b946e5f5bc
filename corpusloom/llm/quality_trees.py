"""Quality rules: a fixed base rule, then gradient-boosted trees over document statistics.

The statistics are counted over every whole text.  The trees are fitted on a
bounded sample of labelled rows, depth-wise over binned features, with
monotonic constraints on chosen features: a split whose children would order
the wrong way is not taken, and the bounds of the parent hold below it.  The
forest is flattened into node arrays, so a block of rows walks every tree with
a few numpy operations.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE, map_rows, read_columns, record

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW_WORDS = 5
SAMPLE_ROWS = 20_000
NOT_SYMBOL = re.compile(r"[^#*$%&|<>]+")
ASCII = re.compile(r"[\x00-\x7f]+")

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_chars", "n_lines", "n_stops", "n_unique", "n_upper", "n_digits"]
STATS_SCHEMA = "doc_id {}, " + ", ".join(f"{c} bigint" for c in STATS + EXTRA)

FEATURES = [
    "words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "line_words",
    "stop_share", "unique_share", "upper_share", "digit_share",
]
# 1: the score may only rise with the feature; -1: it may only fall.
CONSTRAINTS = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "digit_share": -1}


def repeat_words(words: Sequence[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of words found twice or more in the text, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) ** window < 1 << 63:
        code = np.zeros(n, dtype=np.int64)
        for at in range(window):
            code = code * len(known) + ids[at: at + n]
    else:  # number the windows one word at a time
        code = ids[:n]
        for at in range(1, window):
            code = np.unique(code * len(known) + ids[at: at + n], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def capitals(text: str) -> int:
    """Unicode capitals, in texts of any length; A-Z are counted apart because that is quicker."""
    count = sum(text.count(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return count if text.isascii() else count + sum(map(str.isupper, ASCII.sub("", text)))


def text_stats(text: str | None) -> tuple[int, ...]:
    """``STATS`` and ``EXTRA`` of one text; a null text counts as empty."""
    text = text or ""
    words = text.encode().split()
    lines = text.split("\n")
    spoken = [line for line in lines if line.strip(WHITE)]
    return (
        len(words), len(text) - sum(text.count(c) for c in WHITE), len(NOT_SYMBOL.sub("", text)),
        len(spoken) - len(set(spoken)), repeat_words(words),
        len(text), len(lines), text.count(".") + text.count("!") + text.count("?"), len(set(words)),
        capitals(text), sum(text.count(c) for c in "0123456789"),
    )


def document_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of statistics per row of ``docs``."""
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [text_stats(t) for t in batch.column(1).to_pylist()]
        counted = np.array(made, dtype=np.int64).reshape(-1, len(STATS + EXTRA))
        return record(doc_id=batch.column(0), **{c: counted[:, i] for i, c in enumerate(STATS + EXTRA)})
    return map_rows(read_columns(docs, key, text), make, STATS_SCHEMA.format(docs.schema[key].dataType.simpleString()))


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Columns of ``FEATURES`` from arrays of counts."""
    n = {c: np.asarray(v, dtype=np.float64) for c, v in stats.items()}
    words, chars, lines = (np.maximum(n[c], 1) for c in ("n_words", "n_chars", "n_lines"))
    return np.stack([
        np.log1p(n["n_words"]), n["word_chars"] / words, n["n_symbols"] / words, n["n_dup_lines"] / lines,
        n["n_repeat_words"] / words, words / lines, n["n_stops"] / words, n["n_unique"] / words,
        n["n_upper"] / chars, n["n_digits"] / chars,
    ], axis=1)


@dataclass
class Forest:
    """Trees as node arrays; a leaf points at itself and holds its value."""

    feature: np.ndarray
    edge: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of ``x``."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.edge[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, constraints: Sequence[int], trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, min_weight: float = 3.0, penalty: float = 1.0,
) -> Forest:
    """Boosted trees for 0/1 labels under monotonic constraints (1 rising, -1 falling, 0 free).

    Without rows, or with one class only, the forest has no trees and scores
    the smoothed share of ones.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    nodes: list[list[float]] = []
    roots, base = [], float(np.log(share / (1 - share)))
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
        raw = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-raw))
            grad, weight = y - p, p * (1 - p)
            roots.append(len(nodes))
            _grow(nodes, np.arange(len(y)), binned, edges, grad, weight, constraints, depth, rate, min_weight,
                  penalty, -np.inf, np.inf, raw)
    table = np.array(nodes or [[0, 0, 0, 0, 0]], dtype=np.float64)
    return Forest(table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4],
                  np.array(roots, dtype=int), depth, base)


def _grow(nodes, rows, binned, edges, grad, weight, constraints, depth, rate, min_weight, penalty, low, high, raw):
    """Append the node for ``rows`` and those below it; leaves add their value to ``raw``."""
    me = len(nodes)
    total_g, total_w = grad[rows].sum(), weight[rows].sum()
    leaf = float(np.clip(total_g / (total_w + penalty), low, high))
    nodes.append([0, np.inf, me, me, rate * leaf])
    best, gain_needed = None, 1e-6
    for f, cuts in enumerate(edges if depth else []):
        if not len(cuts):
            continue
        g = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(cuts) + 1))[:-1]
        w = np.cumsum(np.bincount(binned[rows, f], weight[rows], len(cuts) + 1))[:-1]
        left = np.clip(g / (w + penalty), low, high)
        right = np.clip((total_g - g) / (total_w - w + penalty), low, high)
        gain = g * g / (w + penalty) + (total_g - g) ** 2 / (total_w - w + penalty) - total_g ** 2 / (total_w + penalty)
        allowed = (w >= min_weight) & (total_w - w >= min_weight) & (constraints[f] * (right - left) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > gain_needed:
            best, gain_needed = (f, at, left[at], right[at]), gain[at]
    if best is None:
        raw[rows] += rate * leaf
        return me
    f, at, left, right = best
    middle = (left + right) / 2
    to_left = binned[rows, f] <= at
    # With a rising feature everything on the left stays below the middle, and so on.
    l_high, r_low = (min(high, middle), max(low, middle)) if constraints[f] > 0 else (high, low)
    l_low, r_high = (max(low, middle), min(high, middle)) if constraints[f] < 0 else (low, high)
    rest = (binned, edges, grad, weight, constraints, depth - 1, rate, min_weight, penalty)
    nodes[me] = [f, edges[f][at], 0, 0, 0]
    nodes[me][2] = _grow(nodes, rows[to_left], *rest, l_low, l_high, raw)
    nodes[me][3] = _grow(nodes, rows[~to_left], *rest, r_low, r_high, raw)
    return me


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fit on at most ``sample_rows`` labelled rows, those with the smallest hash of their key.

    ``labels`` has ``doc_id, quality``; null labels and keys are left out, and
    a key that is labelled or present twice counts once.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id")  # sample_rows at most
    stats = document_stats(texts).dropDuplicates(["doc_id"])
    sample = stats.join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toPandas()
    return fit_forest(
        features({c: sample[c].to_numpy() for c in STATS + EXTRA}), sample["quality"].to_numpy(),
        [CONSTRAINTS.get(c, 0) for c in FEATURES])


def judge(forest: Forest, texts: list[str | None], threshold: float) -> dict[str, np.ndarray]:
    """Counts, ``base_failed``, ``score`` and ``kept`` of some texts."""
    counted = np.array([text_stats(t) for t in texts], dtype=np.int64).reshape(-1, len(STATS + EXTRA))
    counts = {c: counted[:, i] for i, c in enumerate(STATS + EXTRA)}
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
    score = forest.score(features(counts))
    return {c: counts[c] for c in STATS} | {
        "base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Statistics, ``base_failed``, ``score`` and ``kept`` for every row of ``docs``, in one pass.

    The base rule fails texts of under ten words and texts of which over a
    fifth lies in repeated five-word windows; empty and null texts fail it.
    The others are kept when the forest scores ``threshold`` or more.
    Texts of any length are counted whole.  Repeated rows get equal results, a
    null key gets its row too.  Other columns are not looked at.  Without
    labels the forest has no trees and scores one half; no rows give no rows.
    """
    rows = read_columns(docs, key, text)
    forest = train(rows, labels.select("doc_id", "quality"), sample_rows)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return record(doc_id=batch.column(0), **judge(forest, batch.column(1).to_pylist(), threshold))
    kind = rows.schema["doc_id"].dataType.simpleString()
    made = ", ".join(f"{c} bigint" for c in STATS)
    return map_rows(rows, make, f"doc_id {kind}, {made}, base_failed boolean, score double, kept boolean")


def keep_good(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, each judged where it lies: no join, no shuffle."""
    forest = train(docs, labels.select("doc_id", "quality"), sample_rows)
    at = docs.columns.index("text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(judge(forest, batch.column(at).to_pylist(), threshold)["kept"]))
    return map_rows(docs, make, docs.schema)
