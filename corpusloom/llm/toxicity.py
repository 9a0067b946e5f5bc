"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the different hashes of its words, of their stems (the
first four and five bytes of longer words, so that endings not met before don't
hide a word), of neighbouring pairs and of pairs with one word between.  The model learns one text at a time with
a rate of its own for each coordinate; the L1 term keeps coordinates without
enough evidence at exactly zero, so the weights that are sent to the tasks are
a short list.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, read_columns, record

BITS = 20
SAMPLE_ROWS = 8_000
MARKS = str.maketrans("", "", ".,;:!?\"()[]")
STEMS = (4, 5)
_STEM = np.uint64(0xD6E8FEB86659FD93)
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _spread(values: np.ndarray, bits: int) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return ((values ^ (values >> np.uint64(33))) >> np.uint64(64 - bits)).astype(np.int64)


def gram_slots(text: str | None, bits: int = BITS) -> np.ndarray:
    """Slots of all words, stems, pairs and skip-pairs of a text, repeats included; empty texts have none."""
    words = (text or "").translate(MARKS).lower().encode().split()
    stems = [w[:size] for size in STEMS for w in words if len(w) > size]
    h = np.fromiter(map(crc32, words), np.uint64, len(words)) + np.uint64(1)
    s = np.fromiter(map(crc32, stems), np.uint64, len(stems)) + np.uint64(1)
    return _spread(np.concatenate([h * h, s * _STEM, h[:-1] * _PAIR + h[1:], h[:-2] * _SKIP + h[2:]]), bits)


@dataclass
class Weights:
    """The non-zero coordinates of a fitted model."""

    slots: np.ndarray
    values: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, dtype=np.float32)
        table[self.slots] = self.values
        return table

    def scores(self, texts: list[str | None], table: np.ndarray) -> np.ndarray:
        raw = np.empty(len(texts))
        for i, text in enumerate(texts):
            slots = gram_slots(text, self.bits)
            raw[i] = self.bias + table[np.unique(slots[table[slots] != 0])].sum()
        return 1 / (1 + np.exp(-np.clip(raw, -50, 50)))


def fit_ftrl(
    rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, alpha: float = 0.7, beta: float = 1.0,
    l1: float = 5.0, l2: float = 1.0, epochs: int = 4,
) -> Weights:
    """Weights from lists of different slots and 0/1 labels, in the order given.

    The bias learns without penalty.  No rows give the score one half.
    """
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    rows = [np.append(r, 1 << bits) for r in rows]

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.maximum(np.abs(z[at]) - np.where(at == 1 << bits, 0, l1), 0)
        return -np.sign(z[at]) * over / ((beta + np.sqrt(n[at])) / alpha + l2)
    for _ in range(epochs):
        for at, label in zip(rows, labels):
            w = weights(at)
            error = 1 / (1 + np.exp(-np.clip(w.sum(), -50, 50))) - label
            before = n[at]
            n[at] = before + error * error
            z[at] += error - (np.sqrt(n[at]) - np.sqrt(before)) / alpha * w
    every = weights(np.arange((1 << bits) + 1))
    slots = np.flatnonzero(every[:-1])
    return Weights(slots, every[slots], float(every[-1]), bits)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Weights:
    """Fit on at most ``sample_rows`` labelled texts, those with the smallest hash of their key.

    ``labels`` has ``doc_id, toxic``; null keys and labels are left out, a key
    that is there twice counts once.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").cast("double").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.join(F.broadcast(chosen), "doc_id")  # sample_rows at most

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = [np.unique(gram_slots(t, bits)).astype(np.int32) for t in batch.column(1).to_pylist()]
        return record(doc_id=batch.column(0), toxic=batch.column(2),
                      slots=pa.array([s.tobytes() for s in slots], pa.binary()))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_rows(texts.select("doc_id", "text", "toxic"), make, f"doc_id {kind}, toxic double, slots binary")
    got = rows.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").select("toxic", "slots").toPandas()
    return fit_ftrl([np.frombuffer(s, np.int32) for s in got["slots"]], got["toxic"].to_numpy(), bits)


def toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, score`` for every row: how likely its text is labelled toxic, from 0 to 1.

    Only the text enters a score, the whole of it at any length.  Null and
    empty texts get the score of the bias.  Repeated rows get equal scores.
    Other columns are not looked at.  Without labels every score is one half;
    no rows give no rows.
    """
    rows = read_columns(docs, key, text)
    model = train(rows, labels.select("doc_id", "toxic"), sample_rows, bits)
    tables: list[np.ndarray] = []

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not tables:
            tables.append(model.dense())
        return record(doc_id=batch.column(0), score=model.scores(batch.column(1).to_pylist(), tables[0]))
    return map_rows(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
