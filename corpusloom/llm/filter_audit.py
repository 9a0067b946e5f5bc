"""How document filters interact: what each removes under every order of applying them.

The texts are read once, by the byte transducer; what is kept of a document is
its counts and a digest.  Which filters a document fails doesn't depend on
their order, so all orders follow from the number of documents of a part under
each set of failed filters, at most ``2 ** filters`` cells per part.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_rows, record, texts_as_bytes
from corpusloom.llm.transducer import COUNTS, SYMBOLS, text_counts
from corpusloom.session import stage_table

COPY = "copy"    # the rule of documents whose text a smaller id has, too

# A rule is the condition under which a document fails, over the counts of its text.
RULES: dict[str, str] = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_capitals > 5 * n_chars",
    "D": "n_symbols > 0",
    "E": COPY,
}


def text_profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source",
                  symbols: str = SYMBOLS) -> DataFrame:
    """``doc_id, part``, the counts of the whole text and its 256-bit ``digest``; null texts are empty."""
    rows = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).cast("string").alias("text"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_as_bytes(batch.column(2))
        counts = text_counts(texts, symbols)
        digests = [hashlib.blake2b(t, digest_size=32).digest() for t in texts]
        return record(
            doc_id=batch.column(0), part=batch.column(1),
            **{name: counts[:, i] for i, name in enumerate(COUNTS)}, digest=pa.array(digests, pa.binary()))
    kind = docs.schema[key].dataType.simpleString()
    fields = ", ".join(f"{name} bigint" for name in COUNTS)
    return map_rows(rows, make, f"doc_id {kind}, part string, {fields}, digest binary")


def failed_rules(profiles: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``doc_id, part, fails``: a bit for each rule that the document fails, the first rule's lowest.

    A text that several documents have is kept by the smallest id only.  A
    null id is not smaller than any, and none is smaller than it.
    """
    counted = [f"CASE WHEN {rule} THEN {1 << i} ELSE 0 END" for i, rule in enumerate(rules.values()) if rule != COPY]
    copied = sum(1 << i for i, rule in enumerate(rules.values()) if rule == COPY)
    rows = stage_table(
        profiles.select("doc_id", "part", "digest", F.expr(" + ".join(["0", *counted])).alias("fails")), "profiles")
    if not copied:
        return rows.drop("digest")
    # Staged, so that the join has two shuffled sides and can split a text that many documents share.
    first = stage_table(rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"), "copies")
    again = F.when(F.col("doc_id") > F.col("first"), copied).otherwise(0)
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("fails") + again).alias("fails"))


def marked(failed: DataFrame, marks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add the boolean columns of ``marks`` to each document; a mark holds if any row of the document has it."""
    names = [c for c in marks.columns if c != key]
    flags = marks.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(
        *[F.max(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in names])
    flags = stage_table(flags.filter(" OR ".join(f"`{c}`" for c in names)), "marks")
    found = failed.join(flags, "doc_id", "left")
    return found.withColumns({c: F.coalesce(c, F.lit(False)) for c in names})


def steps_of(rules: Mapping[str, str]) -> list[dict]:
    """Each step of each order: its rule's bit and the bits of the rules before it."""
    bits = {name: 1 << i for i, name in enumerate(rules)}
    return [
        {"filter_order": "".join(order), "step": at + 1, "bit": bits[name], "earlier": sum(bits[x] for x in order[:at])}
        for order in permutations(rules) for at, name in enumerate(order)]


def audit(failed: DataFrame, rules: Mapping[str, str] = RULES, marks: tuple[str, ...] = ()) -> DataFrame:
    """A row per part, order of the rules and step; see :func:`filter_audit`."""
    sums = [F.count("*").alias("n"), *[F.sum(F.col(m).cast("bigint")).alias(m) for m in marks]]
    cells = failed.groupBy("part", "fails").agg(*sums)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "n", *marks)).alias("cells"))
    schema = "array<struct<filter_order: string, step: int, bit: int, earlier: int>>"
    steps = parts.select("part", "cells", F.inline(F.from_json(F.lit(json.dumps(steps_of(rules))), schema)))

    def total(of: str, condition, weight=lambda cell: F.lit(1)) -> Column:
        kept = F.filter("cells", condition)
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, cell: acc + cell[of] * weight(cell))

    bit, earlier = F.col("bit"), F.col("earlier")

    def fails(cell) -> Column:
        return cell["fails"].bitwiseAND(bit) != 0

    def reached(cell) -> Column:
        return cell["fails"].bitwiseAND(earlier) == 0

    def share(cell) -> Column:
        """In how many orders the rule comes before all others that the cell fails."""
        return F.floor(F.lit(factorial(len(rules))) / F.bit_count(cell["fails"]))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda c: reached(c) & ~fails(c)).alias("kept"),
        total("n", lambda c: reached(c) & fails(c)).alias("removed"),
        total("n", lambda c: ~reached(c) & fails(c)).alias("redundant"),
        total("n", lambda c: c["fails"] == bit).alias("unique_fails"),
        *[total(m, lambda c: reached(c) & fails(c)).alias(f"{m}_lost") for m in marks],
        total("n", fails, share).alias("shapley"))


def filter_audit(
    docs: DataFrame, labels: DataFrame | None = None, rules: Mapping[str, str] = RULES,
    key: str = "doc_id", text: str = "text", part: str = "source", symbols: str = SYMBOLS,
) -> DataFrame:
    """What each filter removes, for each part, each order of the filters and each step.

    ``rules`` names the filters by letters and gives the condition of failure
    over the counts, or ``COPY``.  The rows have ``part, filter_order, step``
    and numbers of documents: ``kept`` after the step, ``removed`` in it,
    ``redundant`` (failing its filter, removed before), ``unique_fails``
    (failing no other filter), a ``<mark>_lost`` for each boolean column of
    ``labels``, and ``shapley``, what its filter removes summed over all orders.

    Null texts are empty, null parts are the empty string, repeated rows count
    as often as they occur; labels of unknown documents are not looked at, and
    several rows for one document add up.  Other columns don't matter.  No
    documents give no rows.
    """
    failed = failed_rules(text_profiles(docs, key, text, part, symbols), rules)
    names: tuple[str, ...] = ()
    if labels is not None:
        names = tuple(c for c in labels.columns if c != key)
        failed = marked(failed, labels, key)
    return audit(failed, rules, names)
