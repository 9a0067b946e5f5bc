"""Chat formatting over typed content parts, with DataFrame functions only.

A message's content is a list of parts: text, image, audio or document.  A
visitor flattens the parts in order: text stays, every other part becomes a
placeholder that names its kind and number, and is recorded as an attachment
with its reference and the number of tokens that it expands to.

The template writes each turn as ``<|im_start|>role``, a line feed, the
content, ``<|im_end|>`` and a line feed.  Inside roles and texts a backslash
becomes ``\\0``, ``<|`` becomes ``<\\1|`` and, in roles, a line feed ``\\2``; a
text that ends with ``<`` before another part gets ``\\1`` behind it.  So no
text can write a control string, not even over several parts, and the original
is read back exactly.  A placeholder names one of the known kinds, or ``other``.

A conversation is formatted in blocks of turns, and the blocks are joined; the
loss mask is a list of spans (start, length in characters) of each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
BLOCK_TURNS = 64
# Tokens that a part expands to, per unit of its size: image patches, seconds of audio, pages.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 500}
PART_TYPE = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column, line: bool = False) -> Column:
    """Text without control strings; ``line`` also hides line feeds."""
    made = F.replace(F.replace(text, F.lit("\\"), F.lit("\\0")), F.lit("<|"), F.lit("<\\1|"))
    return F.replace(made, F.lit("\n"), F.lit("\\2")) if line else made


def unescape(text: Column) -> Column:
    made = F.replace(F.replace(text, F.lit("\\2"), F.lit("\n")), F.lit("\\1"), F.lit(""))
    return F.replace(made, F.lit("\\0"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content list of one text part."""
    return F.array(F.struct(
        F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("bigint").alias("units")).cast(PART_TYPE))


def expanded_tokens(part: Column) -> Column:
    """Tokens that an attachment takes; unknown kinds and missing sizes take one."""
    rate = F.lit(None).cast("bigint")
    for kind, tokens in TOKENS_PER_UNIT.items():
        rate = F.when(part["kind"] == kind, F.lit(tokens).cast("bigint")).otherwise(rate)
    return F.greatest(F.coalesce(rate * part["units"], F.lit(1).cast("bigint")), F.lit(1).cast("bigint"))


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def visit_parts(parts: Column) -> tuple[Column, Column]:
    """Content with placeholders, and the attachments in order.

    Null lists and parts are left out; a null text is empty.  The kind of an
    attachment is recorded as it is, whatever its placeholder says.
    """
    known = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>")), lambda p: p.isNotNull())
    others = F.filter(known, lambda p: ~is_text(p))

    def shown(part: Column, at: Column) -> Column:
        before = F.size(F.filter(F.slice(known, F.lit(1), at), lambda p: ~is_text(p)))
        kind = F.when(part["kind"].isin(*TOKENS_PER_UNIT), part["kind"]).otherwise("other")
        mark = F.concat(F.lit("<|"), kind, F.lit(":"), before.cast("string"), F.lit("|>"))
        text = escape(F.coalesce(part["text"], F.lit("")))
        cut = F.endswith(text, F.lit("<")) & (at < F.size(known) - 1)
        return F.when(~is_text(part), mark).when(cut, F.concat(text, F.lit("\\1"))).otherwise(text)
    attached = F.transform(others, lambda p, i: F.struct(
        i.cast("bigint").alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"),
        expanded_tokens(p).alias("tokens")))
    return F.array_join(F.transform(known, shown), ""), attached


def format_blocks(messages: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation and block of turns.

    ``messages`` has ``conv_id, turn, role, parts``.  Turns are in order of
    their number, ties in order of role and content.  Columns: ``n_turns``,
    ``formatted``, ``loss`` (spans of assistant contents), ``attachments``.
    Other columns are not looked at.
    """
    content, attached = visit_parts(F.col("parts"))
    turns = messages.select(
        "conv_id", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / block_turns).alias("block"),
        F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        content.alias("content"), attached.alias("attached"))
    head = F.concat(F.lit(TURN_START), escape(F.col("role"), line=True), F.lit("\n"))
    written = turns.select(
        "conv_id", "block", "turn", "role", "content", "attached", head.alias("head"),
        F.char_length(head).alias("n_head"), F.char_length("content").alias("n_content"))
    rows = written.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "content", "head", "n_head", "n_content", "attached"))).alias("t"))
    tail = TURN_END + "\n"
    formatted = F.array_join(F.transform("t", lambda t: F.concat(t["head"], t["content"], F.lit(tail))), "")
    # Starts of the turns, added up from the left.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate("t", start, lambda s, t: F.struct(
        (s["at"] + t["n_head"] + t["n_content"] + len(tail)).alias("at"),
        F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(F.struct(
            (s["at"] + t["n_head"]).alias("start"), t["n_content"].alias("length"))))).otherwise(s["spans"]).alias("spans")))
    return rows.select(
        "conv_id", "block", F.size("t").cast("bigint").alias("n_turns"), formatted.alias("formatted"),
        walked["spans"].alias("loss"), F.flatten(F.transform("t", lambda t: t["attached"])).alias("attachments"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as ``role, text``, with placeholders left in place."""
    chunks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda c: c != "")
    return F.transform(chunks, lambda c: F.struct(
        unescape(F.substring_index(c, "\n", 1)).alias("role"),
        unescape(F.substr(
            c, F.char_length(F.substring_index(c, "\n", 1)) + 2,
            F.char_length(c) - F.char_length(F.substring_index(c, "\n", 1)) - 2 - len(TURN_END))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def format_conversations(messages: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation: the whole formatted text, its loss spans and its attachments.

    Spans are shifted to the whole text.  A null key is a conversation of its
    own; null roles are empty, null contents too.  Repeated rows are repeated
    turns.  No rows give no rows.
    """
    blocks = format_blocks(messages, block_turns)
    sized = blocks.withColumn("n_chars", F.char_length("formatted"))
    rows = sized.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("block", "n_turns", "n_chars", "formatted", "loss", "attachments"))).alias("b"))
    ends = F.transform(F.sequence(F.lit(0), F.size("b") - 1), lambda i: F.aggregate(
        F.slice("b", F.lit(1), i), F.lit(0), lambda s, x: s + x["n_chars"]))
    spans = F.flatten(F.transform(F.arrays_zip(F.col("b").alias("x"), ends.alias("y")), lambda z: F.transform(
        z["x"]["loss"], lambda s: F.struct((s["start"] + z["y"]).alias("start"), s["length"].alias("length")))))
    return rows.select(
        "conv_id", F.aggregate("b", F.lit(0).cast("bigint"), lambda s, x: s + x["n_turns"]).alias("n_turns"),
        F.array_join(F.transform("b", lambda x: x["formatted"]), "").alias("formatted"), spans.alias("loss"),
        F.flatten(F.transform("b", lambda x: x["attachments"])).alias("attachments"))


def digest_blocks(blocks: DataFrame) -> DataFrame:
    """Digests of what the formatted blocks say, read back from them, one row per conversation."""
    turns = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = blocks.select(
        "conv_id", "block", F.size(read_turns(F.col("formatted"))).cast("bigint").alias("n_turns"), turns.alias("turns"),
        masked_text(F.col("formatted"), F.col("loss")).alias("loss"),
        F.char_length("formatted").cast("bigint").alias("n_chars"))
    joined = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("block", "turns", "loss"))).alias("b"))
    loss = F.array_join(F.transform("b", lambda x: x["loss"]), "")
    return joined.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("b", lambda x: x["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars")
