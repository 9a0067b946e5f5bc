"""SimHash near-duplicates through an inverted index over byte positions.

A 64-bit fingerprint has eight bytes, each with its position.  Two
fingerprints that differ in at most ``max_bits`` bits share at least
``8 - max_bits`` positional bytes, the guaranteed minimum.  A posting of one
positional byte would hold 1/256 of all fingerprints, and its pairs would grow
with the square of the corpus; a posting here is a set of ``key_bytes``
positions with their bytes, and the sets are chosen so that any guaranteed
minimum contains one of them.  Within a posting the shared positional bytes
are tallied, pairs below the minimum are dropped, and the rest is verified
bit by bit.

Equal fingerprints are one entry of the index, so exact copies make no pairs.
A posting with many different fingerprints is not paired: fingerprints that
agree outside some ``max_bits`` positions are all within reach of each other,
so sorting them under each such mask finds every link with a linear number of
rows, and the masks are dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, read_columns, ready, record, sorted_groups, texts_as_bytes
from corpusloom.llm.components import EDGES, apart, components, roots_of
from corpusloom.session import stage_table

SEED = 42
BYTES = 8
HOT_POSTING = 256    # entries beyond which a posting is dealt by masks
MASK_SLICES = 24
LINK_ROWS = 20_000
PAIR_LAG = 32        # postings up to this size are paired in one vectorised pass


def fingerprint(text: bytes, shingle_words: int, seed: int = SEED) -> int:
    """The SimHash of a text: a bit is set when over half of the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], dtype=np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[: len(words) - shingle_words] + 1])
        spans = zip(starts.tolist(), ends[shingle_words - 1:].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64, len(starts))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text is unpacked in parts
        part = hashes[at: at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` with the fingerprint as a signed long; null and blank texts have 0."""
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(t, shingle_words) for t in texts_as_bytes(batch.column(1))]
        return record(doc_id=batch.column(0), fp=np.array(made, dtype=np.uint64).view(np.int64))
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(read_columns(docs, key, text), make, f"doc_id {kind}, fp bigint")


def position_sets(max_bits: int, key_bytes: int) -> list[tuple[int, ...]]:
    """Sets of ``key_bytes`` positions such that every ``8 - max_bits`` positions contain one.

    Greedy: take the set that serves the most subsets not served yet.
    """
    kept = BYTES - max_bits
    if not 1 <= key_bytes <= kept:
        raise ValueError("key_bytes must lie between 1 and 8 - max_bits")
    open_ = {frozenset(c) for c in combinations(range(BYTES), kept)}
    every, chosen = list(combinations(range(BYTES), key_bytes)), []
    while open_:
        best = max(every, key=lambda s: sum(frozenset(s) <= o for o in open_))
        chosen.append(best)
        open_ = {o for o in open_ if not frozenset(best) <= o}
    return chosen


def byte_mask(positions: tuple[int, ...]) -> int:
    return sum(0xFF << (8 * p) for p in positions)


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many positional bytes two rows of fingerprints share."""
    apart = (a ^ b).view(np.uint8).reshape(-1, BYTES)
    return (apart == 0).sum(axis=1)


def _verified(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter first, then the exact distance."""
    keep = np.flatnonzero(shared_bytes(a, b) >= BYTES - max_bits)
    return keep[np.bitwise_count(a[keep] ^ b[keep]) <= max_bits]


def posting_links(group: np.ndarray, fps: np.ndarray, reps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between entries of the same posting; ``group`` is sorted."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    large = np.repeat(sizes > PAIR_LAG, sizes)
    for lag in range(1, PAIR_LAG):
        left = np.flatnonzero((group[lag:] == group[:-lag]) & ~large[:-lag])
        if not len(left):
            break
        left = left[_verified(fps[left], fps[left + lag], max_bits)]
        found.append((reps[left], reps[left + lag]))
    for start, size in zip(starts[sizes > PAIR_LAG], sizes[sizes > PAIR_LAG]):
        own, ids = fps[start: start + size], reps[start: start + size]
        mine = []
        for i in range(size - 1):
            near = i + 1 + _verified(np.full(size - 1 - i, own[i]), own[i + 1:], max_bits)
            mine.append((np.full(len(near), ids[i]), ids[near]))
        a, b = (np.concatenate(side) for side in zip(*mine))
        if len(a):
            nodes, root = roots_of(a, b)  # a spanning star is enough for the components
            found.append((root[nodes != root], nodes[nodes != root]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def mask_links(
    fps: np.ndarray, reps: np.ndarray, shared: int, part: int, parts: int, max_bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links of one posting under every ``parts``-th mask of ``max_bits`` free bits."""
    free = [bit for bit in range(64) if not shared >> bit & 1]
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for n, bits in enumerate(combinations(free, max_bits)):
        if n % parts != part:
            continue
        masked = fps & np.uint64(~sum(1 << x for x in bits) & 0xFFFFFFFFFFFFFFFF)
        order = np.argsort(masked, kind="stable")
        same = masked[order][1:] == masked[order][:-1]
        if same.any():
            a = np.concatenate([a, reps[order][:-1][same]])
            b = np.concatenate([b, reps[order][1:][same]])
            if len(a) > 8 * len(fps):
                nodes, root = roots_of(a, b)
                a, b = root[nodes != root], nodes[nodes != root]
    if len(a):
        nodes, root = roots_of(a, b)
        a, b = root[nodes != root], nodes[nodes != root]
    return a, b


def fingerprint_links(entries: DataFrame, max_bits: int = 3, key_bytes: int = 4) -> DataFrame:
    """Edges ``a, b`` that connect the entries ``fp bigint, rep bigint`` within ``max_bits`` bits.

    Fingerprints must be distinct.  Postings up to ``HOT_POSTING`` entries are
    paired inside a task and verified; larger ones are dealt by masks.
    """
    spark = entries.sparkSession
    ready(spark)
    masks = [byte_mask(s) for s in position_sets(max_bits, key_bytes)]

    def signed(value: int) -> int:
        return value - (1 << 64) if value >> 63 else value
    keys = F.array(*[
        F.struct(F.lit(n).alias("set"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("kept"))
        for n, m in enumerate(masks)])
    postings = entries.select("fp", "rep", F.explode(keys).alias("_k")).select("fp", "rep", "_k.set", "_k.kept")
    sizes = postings.groupBy("set", "kept").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = stage_table(sizes, "postings")
    paired = postings.join(sizes.filter(F.col("n") <= HOT_POSTING), ["set", "kept"])
    paired = paired.repartition("set", "kept").sortWithinPartitions("set", "kept")

    def in_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ("set", "kept"), LINK_ROWS):
            which, kept, fps, reps = (table[c].to_numpy() for c in ("set", "kept", "fp", "rep"))
            group = np.concatenate([[0], np.cumsum((np.diff(which) != 0) | (np.diff(kept) != 0))])
            a, b = posting_links(group, fps.view(np.uint64), reps, max_bits)
            yield record(a=a.astype(np.int64), b=b.astype(np.int64))

    near = paired.select("set", "kept", "fp", "rep").mapInArrow(in_tasks, EDGES)

    hot = postings.join(sizes.filter(F.col("n") > HOT_POSTING), ["set", "kept"]).select(
        "set", "kept", "fp", "rep", F.explode(F.sequence(F.lit(0), F.lit(MASK_SLICES - 1))).alias("part"))

    def one_slice(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, b = mask_links(
            table["fp"].to_numpy().view(np.uint64), table["rep"].to_numpy(), masks[key[0].as_py()],
            key[2].as_py(), MASK_SLICES, max_bits)
        return pa.table({"a": a, "b": b})

    far = hot.groupBy("set", "kept", "part").applyInArrow(one_slice, EDGES)
    return near.unionByName(far)


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, key_bytes: int = 4,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest key that a chain of links reaches, the
    row's own included.  Keys may be of any type that has an order.  Empty and
    null texts share the fingerprint 0 and are linked like any other.  Repeated
    rows are copies.  A row with a null key takes part and has the component of
    its fingerprint, null if nothing in it has a key.  Other columns are not
    looked at.  No rows give no rows.
    """
    rows = stage_table(fingerprints(docs, shingle_words, key, text), "fingerprints")
    entries = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "entries")
    # The nodes are the fingerprints themselves; keys only name the components afterwards.
    found = components(fingerprint_links(entries.select("fp", F.col("fp").alias("rep")), max_bits, key_bytes))
    member = stage_table(entries.join(found, entries["fp"] == found["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least"), "members")
    names = apart(member.groupBy("component").agg(F.min("least").alias("component_id")), "component", "root")
    placed = member.join(names, member["component"] == names["root"]).select("fp", "component_id")
    return rows.join(placed, "fp", "left").select("doc_id", "fp", "component_id")


def keep_first_of_groups(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the smallest of their component.

    Rows that repeat a key are one document, of which one row stays.  Rows
    with a null key cannot be named and all stay.
    """
    found = stage_table(near_duplicates(docs.select("doc_id", "text"), **options), "groups")
    dropped = found.filter("doc_id <> component_id").select("doc_id").distinct()
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    single = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    return single.unionByName(kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"]))
