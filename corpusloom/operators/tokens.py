"""Vocabulary, encoding and labels."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from corpusloom import fixed_values as fv
from corpusloom.functions.labels import IDS, ones_mask
from corpusloom.functions.text import add_once
from corpusloom.functions.word_lists import coded_texts, count_tokens
from corpusloom.session import ship_package

# Reserved tokens take the first ids, in this order.
PAD, BOS, EOS, UNK = 0, 1, 2, 3
RESERVED = [
    "<pad>", "<bos>", "<eos>", "<unk>",
    fv.USER_MARK, fv.IMAGE_MARK, fv.END_MARK, fv.ASSISTANT_MARK,
]
MOST_TOKENS = 1_000_000
ASSISTANT_ID = RESERVED.index(fv.ASSISTANT_MARK)
CODED = StructType([StructField("input_ids", ArrayType(LongType())), StructField("length", IntegerType())])


def pad_token(pad: int | None, eos: int | None, unk: int | None) -> int | None:
    """The padding id: the pad token, else the end token, else the unknown one."""
    return next((t for t in (pad, eos, unk) if t is not None), None)


def top_vocabulary(df: DataFrame, text: Column, k: int) -> DataFrame:
    """The ``k`` most frequent tokens with their counts and ids.

    Tasks count in Python what their Arrow batches hold, so a token leaves a
    task a few times; the ids are ranks over at most ``k`` rows, ties in token
    order.
    """
    ship_package(df.sparkSession)
    counted = df.select(text.cast("string").alias("text")).mapInArrow(count_tokens, "token string, n bigint").groupBy(
        "token").agg(F.sum("n").alias("n"))
    top = counted.filter(~F.col("token").isin(RESERVED)).orderBy(F.desc("n"), "token").limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select("token", "n", (rank + F.lit(len(RESERVED) - 1)).cast("bigint").alias("id"))


def with_reserved(vocabulary: DataFrame) -> DataFrame:
    """Token and id of the vocabulary and of the reserved tokens."""
    reserved = vocabulary.sparkSession.createDataFrame(
        list(zip(RESERVED, range(len(RESERVED)))), "token string, id bigint"
    )
    return reserved.unionByName(vocabulary.select("token", "id"))


def lookup_value(vocabulary: DataFrame, k: int) -> Column:
    """The vocabulary as one value: a list of small maps addressed by hash.

    At most ``k`` tokens plus the reserved ones are in it, so its size is
    bounded by the parameter and not by the data.  Looking a token up scans
    the few entries of one map, inside the row's own task: encoding needs
    neither a join per token nor a shuffle to gather a text's tokens again.
    The value passes through one row and the driver, about 40 bytes an entry,
    so ``k`` may be ``MOST_TOKENS`` at most.
    """
    if not 0 <= k <= MOST_TOKENS:
        raise ValueError(f"k must lie between 0 and {MOST_TOKENS}")
    slots = max(k // 2, 8)
    slot = F.pmod(F.xxhash64("token"), F.lit(slots))
    filled = with_reserved(vocabulary).groupBy(slot.alias("slot")).agg(
        F.collect_list(F.struct("token", "id")).alias("entries")
    )
    every = vocabulary.sparkSession.range(slots).withColumnRenamed("id", "slot")
    empty = F.array().cast("array<struct<token:string,id:bigint>>")
    listed = every.join(filled, "slot", "left").agg(
        F.sort_array(F.collect_list(F.struct("slot", F.coalesce("entries", empty).alias("entries")))).alias("slots")
    )
    return listed.select(
        F.transform("slots", lambda s: F.map_from_entries(s["entries"])).alias("lookup")
    ).scalar()


def split_marks(text: Column, marks: Sequence[str] = tuple(RESERVED[4:])) -> Column:
    """Set chat markers apart, so that they are tokens of their own."""
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(f" {mark} "))
    return text


def encode(
    df: DataFrame, tokens: Column, vocabulary: DataFrame, k: int, cap: Column | int,
    add_bos: bool = True,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask``, ``labels`` and ``length``.

    Unknown tokens get the unknown id; ids are cut on the right to ``cap``;
    ``length`` is the token count before the cut.
    """
    slots = max(k // 2, 8)
    n_special = 1 if add_bos else 0
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    # The lookup is a column of its own, used once and above a generator, so the
    # optimizer puts the subquery's value into the expression: no row carries it.
    split = add_once(df, _tokens=tokens, _room=F.greatest(cap - n_special, F.lit(0)))
    prepared = split.withColumn("_lookup", lookup_value(vocabulary, k))

    def one(token: Column) -> Column:
        entry = F.get(F.col("_lookup"), F.pmod(F.xxhash64(token), F.lit(slots)).cast("int"))
        return F.coalesce(F.try_element_at(entry, token), F.lit(UNK).cast("bigint"))

    body = F.transform(F.slice("_tokens", F.lit(1), F.col("_room")), one)
    ids = F.concat(F.array(F.lit(BOS).cast("bigint")), body) if add_bos else body
    coded = prepared.select(
        *df.columns, ids.cast(IDS).alias("input_ids"),
        (F.size("_tokens") + n_special).cast("int").alias("length"),
    )
    return coded.withColumns({
        "attention_mask": ones_mask(F.col("input_ids")), "labels": F.col("input_ids")
    })


def encode_text(
    df: DataFrame, text: Column, vocabulary: DataFrame, k: int, cap: Column | int,
    add_bos: bool = True,
) -> DataFrame:
    """The same as ``encode`` for the words of a text, which Python splits and looks up on Arrow batches.

    The vocabulary, at most ``k`` tokens, goes through the driver to the tasks
    while the query is built.
    """
    if not 0 <= k <= MOST_TOKENS:
        raise ValueError(f"k must lie between 0 and {MOST_TOKENS}")
    known = dict(zip(RESERVED, range(len(RESERVED)))) | {
        r["token"]: r["id"] for r in vocabulary.select("token", "id").collect()}
    begin = [BOS] if add_bos else []
    cap = cap if isinstance(cap, Column) else F.lit(cap)
    room = F.greatest(cap - len(begin), F.lit(0)).cast("int")

    def work(texts: pa.Array, rooms: pa.Array) -> pa.Array:
        return coded_texts(texts, rooms, known, UNK, begin)
    ship_package(df.sparkSession)
    # Not deterministic by name only: so a later filter on the ids doesn't run it once more.
    coded = F.arrow_udf(work, CODED).asNondeterministic()
    return df.select(*df.columns, coded(text, room).alias("_coded")).select(
        *df.columns, F.col("_coded.input_ids").cast(IDS).alias("input_ids"), F.col("_coded.length").alias("length"),
    ).withColumns({"attention_mask": ones_mask(F.col("input_ids")), "labels": F.col("input_ids")})


def keep_encoded(df: DataFrame) -> DataFrame:
    """Drop rows that got no ids."""
    return df.filter(F.size("input_ids") > 0)


def encoding_report(df: DataFrame, by: str) -> DataFrame:
    """Rows, and rows dropped for having no ids, per value of ``by``."""
    return df.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count_if(F.size("input_ids") == 0).alias("n_dropped")
    )
