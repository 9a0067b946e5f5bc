"""Benchmark decontamination with DataFrame functions only.

A document is contaminated by a benchmark item when one of its windows, as
long as the item, has a weighted five-word-shingle similarity of 0.8 or more
with it.  Texts are lowered and lose everything but letters, digits and white
space, so punctuation and case don't hide a copy.

1. Seeds: a similar window shares shingles with the item, so only places where
   a document has a shingle of some item are looked at.  Similarity bounds the
   number of shared shingles from below; runs of seeds too thin for it go.
   Neither step can lose a window that would pass.
2. Every window left gets a SimHash over its shingles, each told apart by its
   occurrence number, as does every item: so a repeated shingle does not
   outweigh the bits, and the weighted similarity is that of two sets.  A
   multi-index finds all items within ``RADIUS`` bits: the 64 bits are cut into
   blocks, by the pigeonhole principle one block differs in at most
   ``BLOCK_RADIUS`` bits, and each item is filed under all such values of each
   block.
3. Candidates within the radius are verified by their exact similarity, the sum
   of the smaller shingle counts over the sum of the larger ones.

At a similarity of 0.8 two SimHashes differ in 10 bits on average with a
deviation of 3, so a radius of 19 leaves out less than one pair in a thousand
of those that lie exactly at the threshold, and practically none above it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SHINGLE_WORDS, SIMILARITY, WORD_GAP, fresh
from corpusloom.session import stage_table

BLOCK_RADIUS = 3
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # first bit, bits
RADIUS = len(BLOCKS) * (BLOCK_RADIUS + 1) - 1
BROADCAST_SHINGLES = 500_000  # 16 bytes each


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def plain_words(text: Column) -> Column:
    """Lowered words of letters and digits."""
    kept = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return F.filter(F.split(kept, WORD_GAP), lambda w: w != "")


def shingle_hashes(words: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles in order; fewer words than ``size`` make one shingle, none none."""
    def of(w: Column) -> Column:
        at_each = F.transform(
            F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        short = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
            F.array().cast("array<bigint>"))
        return F.when(F.size(w) >= size, at_each).otherwise(short)
    return bound(words, of)


def simhash(hashes: Column) -> Column:
    """A bit is set when over half of the hashes have it."""
    def bit(made: Column, at: Column) -> Column:
        ones = F.size(F.filter(hashes, lambda h: F.getbit(h, at) == 1))
        value = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
        return F.when(2 * ones > F.size(hashes), made.bitwiseOR(value)).otherwise(made)
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), bit)


def numbered(hashes: Column) -> Column:
    """The set of shingles with their occurrence numbers, in no order; a first occurrence is the shingle's own hash.

    The weighted similarity of two lists of shingles is the similarity of these sets.
    """
    def of(own: Column) -> Column:
        again = bound(F.array_sort(own), lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (F.get(s, i - 1) == x))))
        later = F.transform(again, lambda x: F.transform(
            F.sequence(F.lit(2), F.size(F.filter(own, lambda y: y == x))), lambda k: F.xxhash64(x, k)))
        return F.concat(F.array_distinct(own), F.flatten(later))
    return bound(hashes, of)


def block_values(fp: Column) -> list[Column]:
    return [F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint")) for first, bits in BLOCKS]


def near_values(bits: int) -> Column:
    """All ``bits``-wide masks of at most ``BLOCK_RADIUS`` ones."""
    return F.filter(
        F.sequence(F.lit(0).cast("bigint"), F.lit((1 << bits) - 1).cast("bigint")),
        lambda m: F.bit_count(m) <= BLOCK_RADIUS)


def common_count(a: Column, b: Column) -> Column:
    """Sum over all values of the smaller of their two counts."""
    def add(total: Column, x: Column) -> Column:
        return total + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x)))
    return F.aggregate(F.array_distinct(a), F.lit(0), add)


def needed(n_window: Column, n_item: Column, similarity: float) -> Column:
    """Shingles that a window and an item must share."""
    return F.ceil(F.lit(similarity / (1 + similarity)) * (n_window + n_item) - F.lit(1e-9)).cast("int")


def item_table(items: DataFrame) -> DataFrame:
    """``item_id, n_words, shingles, n``; items without a word are left out."""
    words = items.select(F.col("item_id"), plain_words(F.col("text")).alias("w"))
    made = words.select("item_id", F.size("w").alias("n_words"), shingle_hashes(F.col("w")).alias("shingles"))
    return made.withColumn("n", F.size("shingles")).filter("n > 0")


def short_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """First place of each item of under ``SHINGLE_WORDS`` words in each text that holds all its words in a row.

    Such an item is one shingle of its own length, so it is similar only where it is equal.
    """
    short = items.select("item_id", "n_words", F.get("shingles", 0).alias("h"))
    sizes = sorted(r["n_words"] for r in short.select("n_words").distinct().collect())  # four at most
    none = F.array().cast("array<struct<n_words:int,h:bigint,pos:int>>")

    def places(w: Column) -> Column:
        def of(m: int) -> Column:
            at_each = F.transform(F.sequence(F.lit(0), F.size(w) - m), lambda i: F.struct(
                F.lit(m).alias("n_words"), F.xxhash64(F.array_join(F.slice(w, i + 1, m), " ")).alias("h"),
                i.alias("pos")))
            return F.when(F.size(w) >= m, at_each).otherwise(none)
        return F.concat(none, *[of(m) for m in sizes])
    wanted = short.select("n_words", "h").distinct()
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    placed = docs.select("doc_id", "text_hash", F.explode(bound(plain_words(F.col("text")), places)).alias("p")).select(
        "doc_id", "text_hash", "p.*").join(wanted, ["n_words", "h"], "left_semi")
    first = placed.groupBy("doc_id", "text_hash", "n_words", "h").agg(F.min("pos").alias("start"))
    return first.join(short, ["n_words", "h"]).select(
        "doc_id", "text_hash", "item_id", "start", F.lit(1.0).alias("similarity"))


def seed_places(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Where a text has a shingle of some item: ``doc_id, text_hash, n_doc, pos, h``."""
    wanted = items.select(F.explode("shingles").alias("h")).distinct()
    if wanted.count() <= BROADCAST_SHINGLES:
        wanted = F.broadcast(wanted)
    hashed = docs.select("doc_id", "text_hash", shingle_hashes(plain_words(F.col("text"))).alias("_all"))
    placed = hashed.select("doc_id", "text_hash", F.size("_all").alias("n_doc"), F.posexplode("_all").alias("pos", "h"))
    return placed.join(wanted, "h", "left_semi")


def rare_shingles(seeds: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``item, h``: the shingles of each item of which a similar text has one at least, the rarest in the texts.

    A similar text lacks no more than ``n - similarity * n`` of the item's ``n``
    shingles, so it has one of any ``n - similarity * n + 1``.
    """
    frequency = seeds.groupBy("h").agg(F.count("*").alias("f"))
    every = items.select(F.struct("item_id", "n").alias("item"), "n", "shingles", F.explode("shingles").alias("h"))
    ranked = every.join(frequency, "h", "left").groupBy("item", "n", "shingles").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "h"))).alias("s"))
    enough = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9)).cast("int") + 1
    return ranked.select("item", F.explode(F.slice("s", F.lit(1), enough)).alias("p")).select("item", "p.h").distinct()


def seeded_windows(seeds: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``doc_id, text_hash, start, n``: windows with enough seeds of an item of that length.

    Only items of which a text has a rare shingle are looked at in it, and a
    seed meets its items as a list; so a phrase that many items and many texts
    share makes no pairs of them.
    """
    owners = items.select(F.struct("item_id", "n").alias("item"), F.explode(F.array_distinct("shingles")).alias("h")).groupBy(
        "h").agg(F.collect_set("item").alias("owners"))
    likely = seeds.select("doc_id", "text_hash", "h").distinct().join(rare_shingles(seeds, items, similarity), "h").groupBy(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.collect_set("item").alias("likely"))
    own = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))
    met = seeds.join(likely, own).join(owners, "h").select(
        "doc_id", "text_hash", "n_doc", "pos", F.explode(F.array_intersect("likely", "owners")).alias("item"))
    per_item = met.groupBy("doc_id", "text_hash", "n_doc", "item").agg(F.sort_array(F.collect_set("pos")).alias("p")).select(
        "doc_id", "text_hash", "n_doc", "item.*", "p")
    sized = per_item.withColumn("width", F.least("n", "n_doc"))
    counted = sized.withColumn("need", needed(F.col("width"), F.col("n"), similarity)).filter(
        (F.size("p") >= F.col("need")) & (F.col("width") >= F.col("need")))
    # Seeds i … i + need - 1 must fit into the window; it starts behind seed i - 1 and at seed i at the latest.
    low = lambda i: F.greatest(
        F.get("p", i + F.col("need") - 1) - F.col("width") + 1, F.coalesce(F.get("p", i - 1) + 1, F.lit(0)), F.lit(0))
    high = lambda i: F.least(F.get("p", i), F.col("n_doc") - F.col("width"))
    starts = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("p") - F.col("need")),
        lambda i: F.when(low(i) <= high(i), F.sequence(low(i), high(i))).otherwise(F.array().cast("array<int>"))))
    return counted.select("doc_id", "text_hash", "n", "width", F.explode(starts).alias("start")).distinct()


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, text_hash, item_id, start, similarity`` of each text's best window for each item.

    ``docs`` has ``doc_id, text, text_hash``.
    """
    known = stage_table(item_table(items), "items")
    short, known = (known.filter(F.col("n_words") < SHINGLE_WORDS), known.filter(F.col("n_words") >= SHINGLE_WORDS))
    long = long_matches(docs, known, similarity)
    return long if short.isEmpty() else long.unionByName(short_matches(docs, short))


def long_matches(docs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """``matches`` by shingles of five words, for the items of an ``item_table``."""
    seeds = stage_table(seed_places(docs, known), "seeds")
    windows = stage_table(seeded_windows(seeds, known, similarity), "windows")
    owners = stage_table(
        windows.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n", "width")).alias("w")), "owners")
    same = docs["doc_id"].eqNullSafe(owners["doc_id"]) & docs["text_hash"].eqNullSafe(owners["text_hash"])
    texts = docs.join(owners, same).select(
        docs["doc_id"], docs["text_hash"], "w", shingle_hashes(plain_words(F.col("text"))).alias("all"))
    each = texts.select("doc_id", "text_hash", "all", F.explode("w").alias("w")).select(
        "doc_id", "text_hash", F.col("w.start").alias("start"), F.col("w.n").alias("n"),
        F.slice("all", F.col("w.start") + 1, F.col("w.width")).alias("own"))
    marked = stage_table(each.withColumn("fp", bound(numbered(F.col("own")), simhash)), "marked")

    def near_keys(block: int, value: Column, bits: int) -> Column:
        return F.transform(
            near_values(bits), lambda m: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(m).alias("value")))
    filed = known.withColumn("fp_item", bound(numbered(F.col("shingles")), simhash))
    keys = [near_keys(b, v, bits) for b, (v, (_, bits)) in enumerate(zip(block_values(F.col("fp_item")), BLOCKS))]
    index = filed.select("item_id", "n", "fp_item", F.explode(F.flatten(F.array(*keys))).alias("k")).select(
        "item_id", "n", "fp_item", "k.block", "k.value")
    probes = marked.select("doc_id", "text_hash", "start", "n", "fp", F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), v.alias("value")) for b, v in enumerate(block_values(F.col("fp")))
    ])).alias("k")).select("doc_id", "text_hash", "start", "n", "fp", "k.block", "k.value")
    near = probes.join(index, ["n", "block", "value"]).filter(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_item"))) <= RADIUS
    ).select("doc_id", "text_hash", "start", "n", "item_id").distinct()
    named = known.select(F.col("item_id").alias("_item"), F.col("n").alias("_n"), "shingles")
    same_item = F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("n") == F.col("_n"))
    pairs = near.join(named, same_item).drop("_item", "_n").alias("x").join(
        marked.alias("y"), F.col("x.doc_id").eqNullSafe(F.col("y.doc_id"))
        & (F.col("x.text_hash") == F.col("y.text_hash")) & (F.col("x.start") == F.col("y.start"))
        & (F.col("x.n") == F.col("y.n")))
    both = common_count(F.col("y.own"), F.col("x.shingles"))
    scored = pairs.select(
        "x.doc_id", "x.text_hash", "x.item_id", "x.start", both.alias("both"),
        (F.size("y.own") + F.size("x.shingles")).alias("total"),
    ).withColumn("similarity", F.col("both") / (F.col("total") - F.col("both")))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start"))
    return scored.filter(F.col("similarity") >= similarity).groupBy("doc_id", "text_hash", "item_id").agg(
        best.alias("b")).select("doc_id", "text_hash", "item_id", F.col("b.start").alias("start"),
                                (-F.col("b.s")).alias("similarity"))


def contaminated(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, start, similarity``: the best window of each document for each item found in it.

    ``start`` counts words of the plain text from 0; of equal windows the first
    is named.  Null and empty texts and items match nothing.  A text shorter
    than an item is one window.  An item of one to four words is found wherever
    its words stand in a row.  Rows with the same key are one document; a null
    key is named as null.  Other columns are not looked at.  Empty tables give
    no rows.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start"))
    return matches(own, items, similarity).groupBy("doc_id", "item_id").agg(best.alias("b")).select(
        "doc_id", "item_id", F.col("b.start").cast("bigint").alias("start"), (-F.col("b.s")).alias("similarity"))


def without_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; rows are told apart by key and text.

    All columns stay, whatever their names.
    """
    digest = fresh("text_hash", docs.columns)
    hashed = docs.withColumn(digest, F.xxhash64(F.col("text")))
    own = hashed.select("doc_id", "text", F.col(digest).alias("text_hash"))
    hit = stage_table(matches(own, items, similarity).select("doc_id", "text_hash").distinct(), "hits")
    same = hashed["doc_id"].eqNullSafe(hit["doc_id"]) & (hashed[digest] == hit["text_hash"])
    return hashed.join(hit, same, "left_anti").drop(digest)
