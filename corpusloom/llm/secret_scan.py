"""Secrets in texts, told apart by how many owners have them.

Three patterns find the base spans; nothing takes them away again.  Runs of
token characters that no pattern names are candidates, too.  The values of all
candidates are hashed, and the hashes are counted over the whole corpus by
distinct repositories and owners: a value that many owners have was copied
from documentation, one that stays with few is theirs.  A candidate becomes a
span when its value is

* ``reuse``: a live-looking value that a base span holds somewhere, or
* ``bare``: by its form a generated token, with few owners.

Hot values are aggregated before the shuffle, and the join that brings the
verdicts back has two shuffled sides, so that it can split them.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, record, texts_as_bytes
from corpusloom.session import stage_table

WIDE_OWNERS = 3                  # from so many owners on a value is a copied example
KINDS = ("assign", "access", "hex", "reuse", "bare")
BASE_KINDS = 3
BLOCK_BYTES = 1 << 20

NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
# Patterns of bytes fold the case of ASCII letters only.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{12,}")
HEX = re.compile(rb"[0-9a-f]{32,}")
GENERATED = re.compile(rb"(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z])(?=[^0-9]*[0-9])[A-Za-z0-9+_=-]{20,}")
ASSIGN_LEAST, RUN_LEAST, VARIED, GENERATED_VARIED = 8, 8, 8, 12
TRIMMED = b"._=+/-"

_token, _digit = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_token[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_digit[list(b"0123456789")] = True
NO_TOKEN = re.compile(rb"[^A-Za-z0-9+/_.=-]")

FOUND = "array<struct<kind: int, first: bigint, past: bigint, value: binary, varied: boolean, generated: boolean>>"


def token_runs(text: bytes, block: int = BLOCK_BYTES) -> list[tuple[int, int]]:
    """Maximal runs of token characters that may hold a candidate; long texts are cut between runs."""
    found: list[tuple[int, int]] = []
    at = 0
    while at < len(text):
        gap = NO_TOKEN.search(text, at + block) if at + block < len(text) else None
        end = gap.start() if gap else len(text)
        data = np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at)
        inside = np.concatenate([[False], _token[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        digits = np.flatnonzero(_digit[data])
        some = np.searchsorted(digits, ends) > np.searchsorted(digits, starts)
        kept = (some & (ends - starts >= RUN_LEAST)) | (ends - starts >= 16)
        found += zip((starts[kept] + at).tolist(), (ends[kept] + at).tolist())
        at = end
    return found


def candidates(text: bytes, block: int = BLOCK_BYTES) -> list[tuple[int, int, int, bytes]]:
    """``kind, first, past, value`` of base spans and other candidates (kind ``BASE_KINDS``), in bytes."""
    found: list[tuple[int, int, int, bytes]] = []
    low = text.lower()
    if any(name in low for name in NAMES):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append((0, m.start(), m.end(), m[2]))
    runs = token_runs(text, block)
    for start, end in runs:
        run = text[start:end]
        if len(run) >= 16:
            if b"AKIA" in run:
                found += [(1, start + m.start(), start + m.end(), m[0]) for m in ACCESS.finditer(run)]
            found += [(2, start + m.start(), start + m.end(), m[0]) for m in HEX.finditer(run)]
    base = sorted((first, past) for _, first, past, _ in found)
    begins = np.array([b for b, _ in base], dtype=np.int64)
    reach = np.maximum.accumulate([p for _, p in base]) if base else begins
    for start, end in runs:
        run = text[start:end]
        value = run.strip(TRIMMED)
        first = start + len(run) - len(run.lstrip(TRIMMED))
        past = first + len(value)
        before = int(np.searchsorted(begins, past))
        if before and reach[before - 1] > first:
            continue
        if len(value) >= RUN_LEAST and re.search(rb"[0-9]", value) and re.search(rb"[A-Za-z]", value):
            found.append((BASE_KINDS, first, past, value))
    return found


def point_offsets(text: bytes, places: list[int]) -> dict[int, int]:
    """Code points before each of the byte places."""
    if text.isascii():
        return {p: p for p in places}
    ordered = sorted({0, *places})
    begins = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    counts = [np.count_nonzero(begins[a:b]) for a, b in zip(ordered, ordered[1:])]
    return dict(zip(ordered, [0, *np.cumsum(counts).tolist()]))


def scanned(docs: DataFrame, key: str, text: str, owner: str | Column, repository: str | Column) -> DataFrame:
    """``doc_id, owner, repository, found``: the candidates of each whole text, in code points."""
    def name(column: str | Column) -> Column:
        column = F.col(column) if isinstance(column, str) else column
        return F.coalesce(column.cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), name(owner).alias("owner"), name(repository).alias("repository"),
        F.col(text).cast("string").alias("text"))

    def row(data: bytes) -> list[dict]:
        spans = candidates(data)
        if not spans:
            return []
        at = point_offsets(data, [p for _, first, past, _ in spans for p in (first, past)])
        made = []
        for kind, first, past, value in spans:
            value = value.strip(TRIMMED)
            made.append({
                "kind": kind, "first": at[first], "past": at[past],
                "value": hashlib.blake2b(value, digest_size=16).digest(),
                "varied": len(set(value)) >= VARIED and any(48 <= c <= 57 for c in value),
                "generated": len(set(value)) >= GENERATED_VARIED and GENERATED.fullmatch(value) is not None})
        return made

    entry = pa.struct([("kind", pa.int32()), ("first", pa.int64()), ("past", pa.int64()), ("value", pa.binary()),
                       ("varied", pa.bool_()), ("generated", pa.bool_())])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [row(t) for t in texts_as_bytes(batch.column(3))]
        return record(doc_id=batch.column(0), owner=batch.column(1), repository=batch.column(2),
                      found=pa.array(found, pa.list_(entry)))
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(rows, make, f"doc_id {kind}, owner string, repository string, found {FOUND}")


def ownership(occurrences: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """``value, n_repositories, n_owners, named, verdict`` of every candidate value.

    ``named`` values have a base span somewhere.  The verdict is ``example``
    from ``wide_owners`` owners on, else ``live`` for a varied value.
    """
    kept = occurrences.groupBy("value", "owner", "repository").agg(
        F.max(F.col("kind") < BASE_KINDS).alias("named"), F.max("varied").alias("varied"))
    # One row per value and owner next, so that a value that all have is still summed in many tasks.
    by_owner = kept.groupBy("value", "owner").agg(
        F.count("*").alias("repositories"), F.max("named").alias("named"), F.max("varied").alias("varied"))
    return by_owner.groupBy("value").agg(
        F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners"),
        F.max("named").alias("named"), F.max("varied").alias("varied"),
    ).select("value", "n_repositories", "n_owners", "named", F.when(
        F.col("n_owners") >= wide_owners, "example").when(F.col("varied"), "live").otherwise("plain").alias("verdict"))


def scan_secrets(
    docs: DataFrame, owner: str | Column, repository: str | Column, wide_owners: int = WIDE_OWNERS,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, spans`` for every row: an array of ``first, kind, past, verdict, n_repositories, n_owners``.

    Spans are in code points, ``past`` exclusive, ordered by start and kind;
    ``kind`` is an index into ``KINDS``.  A span of kind ``assign`` is the
    whole match, its value the part behind the sign.  A repository belongs to
    an owner: two repositories of one name under two owners are two.

    Null texts are empty and have no spans; a null owner or repository counts
    as one of the empty name.  Repeated rows are rows of their own, keys may be
    null, other columns don't matter.  No rows give no rows.
    """
    rows = scanned(docs, key, text, owner, repository).withColumn("row", F.monotonically_increasing_id())
    rows = stage_table(rows, "candidates")  # numbers rows once and for all
    some = rows.filter(F.size("found") > 0).select("row", "doc_id", "owner", "repository", F.inline("found"))
    verdicts = stage_table(ownership(some, wide_owners), "verdicts")
    judged = some.join(verdicts, "value", "left")
    live = F.col("verdict") == "live"
    kind = (F.when(F.col("kind") < BASE_KINDS, F.col("kind"))
            .when(live & F.col("named"), F.lit(KINDS.index("reuse")))
            .when(live & F.col("generated"), F.lit(KINDS.index("bare"))))
    span = F.struct("first", kind.alias("kind"), "past", "verdict", "n_repositories", "n_owners")
    grouped = judged.groupBy("row", "doc_id").agg(
        F.array_sort(F.collect_list(F.when(kind.isNotNull(), span))).alias("spans")).select("doc_id", "spans")
    none = F.array().cast(grouped.schema["spans"].dataType)
    return grouped.unionByName(rows.filter(F.size("found") == 0).select("doc_id", none.alias("spans")))
