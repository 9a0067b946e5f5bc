"""Stupid-backoff scores: hash-partitioned n-gram counts joined to exploded n-grams, summed per document.

Texts are handled in chunks.  A chunk explodes into its different words and
word pairs with their counts, dealt by hash into buckets.  A bucket is one part
of the corpus count table: it adds up the counts of its keys over all chunks
and answers each chunk.  The answers meet the chunk's documents again, and
every position of a document is scored and summed.

A pair counts as seen from ``min_count`` occurrences in the corpus on:
``S(w | v) = c(v w) / c(v)``; otherwise ``S(w | v) = backoff * c(w) / N``.  The
first word of a text has ``c(w) / N``.

A frequent word is one key of each chunk however often it occurs, so no bucket
is hot, and the number of buckets follows the session's shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from corpusloom.llm.common import read_columns, ready, record, texts_as_bytes

BACKOFF = 0.4
MIN_COUNT = 2
CHUNK_WORDS = 1_000_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)
TOTAL = np.uint64(0x746F74616C)  # the key under which chunks add up their words


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * _PAIR + (right ^ (right >> np.uint64(29)))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(31))


def to_planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, all lowest bytes first: the higher ones are mostly zero and compress away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


class Chunk:
    """Some documents as numbers of different words, with the keys they ask the count table for."""

    def __init__(self, words: np.ndarray, at: np.ndarray, sizes: np.ndarray):
        self.words, self.at, self.sizes = words, at, sizes
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.inner = np.flatnonzero(self.doc[1:] == self.doc[:-1]) + 1  # positions with a word before them
        code = at[self.inner - 1] * max(len(words), 1) + at[self.inner]
        self.pairs, self.pair_at, self.pair_counts = np.unique(code, return_inverse=True, return_counts=True)

    @classmethod
    def of(cls, texts: list[bytes]) -> Chunk:
        split = [t.lower().split() for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        hashes = np.fromiter(
            (h for words in split for h in map(xxhash.xxh64_intdigest, words)), np.uint64, int(sizes.sum()))
        words, at, often = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")  # frequent words get small numbers, which pack well
        rank = np.empty(len(words), dtype=np.int64)
        rank[order] = np.arange(len(words))
        return cls(words[order], rank[at], sizes)

    def keys(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys in the order of their buckets, that order, and the bounds of the buckets."""
        n = max(len(self.words), 1)
        pairs = pair_keys(self.words[self.pairs // n], self.words[self.pairs % n])
        keys = np.concatenate([self.words, pairs, [TOTAL]])
        bucket = ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return keys[order], order, np.searchsorted(bucket[order], np.arange(buckets + 1))

    def counts(self) -> np.ndarray:
        single = np.bincount(self.at, minlength=len(self.words))
        return np.concatenate([single, self.pair_counts, [len(self.at)]])

    def score(self, corpus: np.ndarray, backoff: float, min_count: int) -> tuple[np.ndarray, np.ndarray]:
        """Per document the sum of log10 scores and the number of seen pairs."""
        single, pairs, total = corpus[: len(self.words)], corpus[len(self.words): -1], corpus[-1]
        logs = np.log10(single[self.at] / max(total, 1)) if len(self.at) else np.empty(0)
        both = pairs[self.pair_at]
        seen = both >= min_count
        logs[self.inner] += np.log10(backoff)
        hit = self.inner[seen]
        logs[hit] = np.log10(both[seen] / single[self.at[hit - 1]])
        n = len(self.sizes)
        return np.bincount(self.doc, logs, n).astype(float), np.bincount(self.doc[hit], minlength=n)


def cut_chunks(batches: Iterator[pa.RecordBatch], chunk_words: int) -> Iterator[tuple[int, pa.Array, list[bytes]]]:
    """Chunks of whole texts of about ``chunk_words`` words, told by their bytes; numbered by task and order."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    keys: list[pa.Array] = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        begin = 0
        for i, text in enumerate(texts_as_bytes(batch.column(1))):
            texts.append(text)
            held += len(text)
            if held > 6 * chunk_words:
                keys.append(batch.column(0).slice(begin, i + 1 - begin))
                yield number, pa.concat_arrays(keys), texts
                number, keys, texts, held, begin = number + 1, [], [], 0, i + 1
        keys.append(batch.column(0).slice(begin))
    if texts:
        yield number, pa.concat_arrays(keys), texts
    pa.default_memory_pool().release_unused()


def exploded(docs: DataFrame, buckets: int, chunk_words: int) -> DataFrame:
    """``bucket, chunk, keys, counts``: each chunk's different n-grams by hash bucket."""
    def run(batches):
        for number, _, texts in cut_chunks(batches, chunk_words):
            chunk = Chunk.of(texts)
            keys, order, bounds = chunk.keys(buckets)
            counts = np.minimum(chunk.counts()[order], np.iinfo(np.uint32).max).astype(np.uint32)
            some = np.flatnonzero(np.diff(bounds))
            yield record(
                bucket=some, chunk=np.full(len(some), number),
                keys=pa.array([keys[bounds[b]: bounds[b + 1]].tobytes() for b in some], pa.binary()),
                counts=pa.array([to_planes(counts[bounds[b]: bounds[b + 1]]) for b in some], pa.binary()))
    return docs.mapInArrow(run, "bucket bigint, chunk bigint, keys binary, counts binary")


def numbered_documents(docs: DataFrame, chunk_words: int) -> DataFrame:
    """One row per chunk: its documents as numbers into its list of word hashes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for number, keys, texts in cut_chunks(batches, chunk_words):
            chunk = Chunk.of(texts)
            yield record(
                chunk=[number], doc_id=pa.array([keys.to_pylist()], pa.list_(keys.type)),
                sizes=[chunk.sizes.tobytes()], words=[chunk.words.tobytes()],
                at=[to_planes(chunk.at)])
    return docs.mapInArrow(run, f"chunk bigint, doc_id array<{kind}>, sizes binary, words binary, at binary")


def backoff_scores(
    docs: DataFrame, backoff: float = BACKOFF, min_count: int = MIN_COUNT, chunk_words: int = CHUNK_WORDS,
    buckets: int | None = None, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_seen, log10_sum`` for every row; counts are over all rows.

    Words are runs of anything but ASCII white space, A-Z lowered.  Null and
    empty texts have no words and the sum 0.  A repeated row counts and is
    scored each time; null keys stay null.  No rows give no rows.  ``docs`` is
    read twice and must yield its rows in the same order, as files do; a
    shuffled table has to be staged before.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = read_columns(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def count_bucket(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        own = [from_planes(c) for c in table["counts"].to_pylist()]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(at, np.concatenate(own), len(different))[at].astype(np.int64)
        answers = np.split(counts, np.cumsum([len(k) for k in keys])[:-1])
        # Most counts fit into four bytes; a chunk's answer is wider where one does not.
        narrow = [a.astype(np.uint32) if a.max(initial=0) < 1 << 32 else a for a in answers]
        return pa.table({
            "chunk": table["chunk"], "bucket": table["bucket"], "wide": [a.dtype == np.int64 for a in narrow],
            "corpus": pa.array([a.tobytes() if a.dtype == np.int64 else to_planes(a) for a in narrow], pa.binary())})

    def score_chunk(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for row in left.to_pylist():
            chunk = Chunk(np.frombuffer(row["words"], np.uint64), from_planes(row["at"]).astype(np.int64),
                          np.frombuffer(row["sizes"], np.int64))
            _, order, _ = chunk.keys(buckets)
            answers = sorted(zip(right["bucket"].to_pylist(), right["wide"].to_pylist(), right["corpus"].to_pylist()))
            told = np.concatenate([np.frombuffer(c, np.int64) if w else from_planes(c) for _, w, c in answers])
            if len(told) != len(order):
                raise ValueError("the documents came in another order the second time; stage them first")
            corpus = np.empty(len(order), dtype=np.float64)
            corpus[order] = told
            logs, seen = chunk.score(corpus, backoff, min_count)
            parts.append(pa.table({
                "doc_id": pa.array(row["doc_id"], left.schema.field("doc_id").type.value_type), "n_words": chunk.sizes,
                "n_seen": seen.astype(np.int64), "log10_sum": logs}))
        return pa.concat_tables(parts)

    counted = exploded(rows, buckets, chunk_words).groupBy("bucket").applyInArrow(
        count_bucket, "chunk bigint, bucket bigint, wide boolean, corpus binary")
    documents = numbered_documents(rows, chunk_words)
    return documents.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        score_chunk, f"doc_id {kind}, n_words bigint, n_seen bigint, log10_sum double")

