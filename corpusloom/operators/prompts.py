"""Prompt texts from role-mapped rows and from conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import answer_text, clean_text, keep_nonblank, strip
from corpusloom.operators.roles import roles_of, task_of
from corpusloom.operators.series import next_in_group


def _cleaned(value: Column, mode: str) -> Column:
    return F.when(value.isNotNull(), clean_text(value, mode))


def sft_text(question: Column | None, answer: Column | None, mode: str = "math") -> Column:
    """Cleaned question and answer with a blank line between.

    A null part is left out; a part that is cleaned away keeps its separator.
    """
    parts = [_cleaned(p, mode) for p in (question, answer) if p is not None]
    return F.concat_ws(fv.PART_SEPARATOR, *parts)


def multimodal_text(question: Column | None, answer: Column | None, mode: str = "math") -> Column:
    """Like :func:`sft_text`, but blank parts are left out before cleaning."""
    parts = [
        F.when(strip(p) != "", clean_text(p, mode)) for p in (question, answer) if p is not None
    ]
    return F.concat_ws(fv.PART_SEPARATOR, *parts)


def instruction_text(
    instruction: Column, extra: Column, output: Column, mode: str = "math",
    heads: Sequence[str] = (fv.INSTRUCTION_HEAD, fv.INPUT_HEAD, fv.RESPONSE_HEAD),
) -> Column:
    """Headed instruction, optional input and response sections, then cleaned."""
    told, given, said = (strip(F.coalesce(c, F.lit(""))) for c in (instruction, extra, output))
    section = F.when(
        (told != "") & (given != ""), F.concat(F.lit(heads[1]), given, F.lit(fv.PART_SEPARATOR))
    ).otherwise("")
    whole = F.concat(
        F.lit(heads[0]), told, F.lit(fv.PART_SEPARATOR), section, F.lit(heads[2]), said
    )
    return clean_text(whole, mode)


def vision_prompt(text: Column, answer: Column | None = None) -> Column:
    """User turn with an image slot, then the assistant marker and the answer."""
    parts = [
        F.lit(f"{fv.USER_MARK}\n{fv.IMAGE_MARK}\n"), text,
        F.lit(f"{fv.END_MARK}\n{fv.ASSISTANT_MARK}"),
    ]
    if answer is not None:
        parts += [F.lit("\n"), answer]
    return F.concat(*parts)


def turn_text(role: Column, text: Column) -> Column:
    """One rendered turn of a conversation."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit(fv.END_MARK))


def render_messages(messages: Column, mode: str = "math") -> Column:
    """A typed message list as one text, turns in list order."""
    rendered = F.transform(messages, lambda m: turn_text(m["role"], clean_text(m["text"], mode)))
    return F.array_join(rendered, "\n")


def render_conversations(turns: DataFrame, mode: str = "math", part_turns: int = 256) -> DataFrame:
    """A turn table as texts, turns in order.

    A conversation is rendered in parts of ``part_turns`` turn numbers, so a
    huge one is rendered in many tasks.  :func:`whole_conversations` joins the
    parts; a consumer that streams texts can take them as they are.
    """
    part = F.floor(F.col("turn") / part_turns).alias("part")
    lines = turns.select(
        "conv_id", part, "turn", turn_text(F.col("role"), clean_text(F.col("text"), mode)).alias("line")
    )
    gathered = lines.groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("turn", "line"))).alias("lines")
    )
    return gathered.select(
        "conv_id", "part", F.size("lines").alias("n_turns"),
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("text"),
    )


def whole_conversations(parts: DataFrame) -> DataFrame:
    """One row per conversation: its rendered parts joined by line, in order."""
    gathered = parts.groupBy("conv_id").agg(
        F.sum("n_turns").cast("int").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts"))
    return gathered.select(
        "conv_id", "n_turns", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))


def question_answer_pairs(turns: DataFrame, block_size: int = 1024) -> DataFrame:
    """User turns with the assistant turn that directly follows."""
    paired = next_in_group(
        turns.select("conv_id", "turn", "role", "text"), "conv_id", "turn", ["role", "text"], block_size
    )
    return paired.filter((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer")
    )


def prompt_table(
    df: DataFrame, mode: str = "math", task: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Any supported table as ``text`` rows, blank ones dropped.

    Detects the task unless one is given, maps the roles, builds the text and
    keeps the key columns (and the image in the image task).
    """
    task = task_of(df) if task is None else task
    roles = roles_of(df, task)
    part = {r: answer_text(df, c) for r, c in roles.items() if c is not None and r != "image"}
    kept = [F.col(k) for k in keys]
    if task == "multimodal":
        text = multimodal_text(part.get("question"), part.get("chosen"), mode)
        kept += [F.col(roles["image"]).alias("image")] if roles["image"] else []
    elif task == "sft":
        text = sft_text(part.get("question"), part.get("chosen"), mode)
    elif task == "chat":
        kind = df.schema[roles["question"]].dataType.simpleString()
        typed = kind.startswith("array<struct<")
        column = F.col(roles["question"])
        text = render_messages(column, mode) if typed else _cleaned(part["question"], mode)
    else:
        text = clean_text(part["chosen"], mode)
    names = list(keys) + (["image"] if task == "multimodal" and roles["image"] else [])
    sources = df.select(*kept, text.alias("_text")) if kept else df.select(text.alias("_text"))
    return keep_nonblank(sources, F.col("_text")).select(*names, "text")


def retention_report(df: DataFrame, text: Column, by: str) -> DataFrame:
    """Rows, and rows whose text is not blank, per value of ``by``."""
    return df.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count_if(strip(text) != "").alias("n_kept")
    )
