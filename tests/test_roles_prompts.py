import pytest
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.operators import ordering, prompts, roles
from corpusloom.sources.tables import load_tables

SHAPES = {
    "plain_sft": "instruction string, response string",
    "answer_order": "summary string, Output string, query string, context string",
    "causal": "id long, text string",
    "both_causal": "TEXT string, prompt string",
    "untyped_messages": "messages string",
    "typed_messages": "messages array<struct<role:string,text:string>>",
    "image": "Photo binary, caption string, text string",
    "image_no_answer": "image binary, text string",
    "image_sft": "img binary, answer string, question string",
    "same_lower_case": "Text string, text string, TEXT string",
    "nothing": "a string, b int",
}
TASKS = {
    "plain_sft": "sft", "answer_order": "sft", "causal": "causal", "both_causal": "causal",
    "untyped_messages": "sft", "typed_messages": "chat", "image": "multimodal",
    "image_no_answer": "causal", "image_sft": "multimodal", "same_lower_case": "causal", "nothing": None,
}
# question, chosen, image
MAPPED = {
    "plain_sft": ("instruction", "response", None), "answer_order": ("query", "Output", None),
    "causal": (None, "text", None), "both_causal": (None, "prompt", None),
    "untyped_messages": (None, "messages", None), "typed_messages": ("messages", None, None),
    "image": ("text", "caption", "Photo"), "image_no_answer": (None, "text", None),
    "image_sft": ("question", "answer", "img"), "same_lower_case": (None, "TEXT", None),
    "nothing": (None, None, None),
}


@pytest.fixture(scope="module")
def shapes(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    made = {name: spark.createDataFrame([], schema) for name, schema in SHAPES.items()}
    spark.conf.unset("spark.sql.caseSensitive")
    return made


def test_catalog_and_single_table_agree(spark, shapes):
    mapped = roles.map_roles(roles.column_catalog(spark, shapes))
    rows = {r.table_name: r for r in mapped.collect()}
    assert set(rows) == set(SHAPES)
    for name, row in rows.items():
        assert row.task == TASKS[name], name
        assert (row.question, row.chosen, row.image) == MAPPED[name], name
        assert row.rejected is None
        if TASKS[name]:
            assert roles.task_of(shapes[name]) == TASKS[name]
            found = roles.roles_of(shapes[name])
            assert (found["question"], found["chosen"], found["image"]) == MAPPED[name]


def test_no_fitting_task_is_an_error(shapes):
    with pytest.raises(ValueError, match="no task fits"):
        roles.task_of(shapes["nothing"])


def test_task_can_be_forced(shapes):
    assert roles.roles_of(shapes["image_no_answer"], "multimodal")["image"] == "image"


def test_coverage_counts_blank_answers(spark):
    tables = {"t": spark.createDataFrame([("a",), (" \t",), (None,)], "text string")}
    assert roles.role_coverage(tables).collect() == [("t", 3, 1)]


def texts(df):
    return [r.text for r in df.collect()]


def test_sft_text_skips_nulls_but_keeps_the_separator_of_cleaned_parts(spark):
    rows = spark.createDataFrame(
        [("q", "a"), (None, "a"), ("q", None), ("[DUMMY]", "a"), (None, None)], "question string, response string"
    )
    both = prompts.sft_text(F.col("question"), F.col("response"))
    assert texts(rows.select(both.alias("text"))) == ["q\n\na", "a", "q", "\n\na", ""]
    assert texts(prompts.prompt_table(rows)) == ["q\n\na", "a", "q", "\n\na"]


def test_multimodal_text_skips_blank_parts_first(spark):
    rows = spark.createDataFrame([(" ", "a"), ("[DUMMY]", "a"), ("q", ""), (None, None)], "q string, a string")
    text = prompts.multimodal_text(F.col("q"), F.col("a"))
    assert texts(rows.select(text.alias("text"))) == ["a", "\n\na", "q", ""]


def test_instruction_sections(spark):
    rows = spark.createDataFrame(
        [("do", "this", "done"), ("do", " ", "done"), ("", "this", "done"), (None, None, None)],
        "i string, x string, o string",
    )
    text = prompts.instruction_text(F.col("i"), F.col("x"), F.col("o"), "math")
    assert texts(rows.select(text.alias("text"))) == [
        "Instruction: do Input: this Response: done", "Instruction: do Response: done",
        "Instruction: Response: done", "Instruction: Response:",
    ]


def test_vision_prompt(spark):
    row = spark.createDataFrame([("hello", "yes")], "t string, a string")
    plain, answered = row.select(
        prompts.vision_prompt(F.col("t")), prompts.vision_prompt(F.col("t"), F.col("a"))
    ).first()
    assert plain == "<|user|>\n<|image_1|>\nhello<|end|>\n<|assistant|>"
    assert answered == plain + "\nyes"


def test_chat_from_lists_and_from_turns(spark):
    messages = spark.createDataFrame(
        [(1, [("user", "hi!!"), ("assistant", "yo")])], "i int, messages array<struct<role:string,text:string>>"
    )
    want = "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>"
    assert texts(prompts.prompt_table(messages, keys=["i"])) == [want]
    turns = spark.createDataFrame(
        [(1, 1, "assistant", "yo"), (1, 0, "user", "hi!!"), (1, 9, "user", "more")],
        "conv_id long, turn long, role string, text string",
    )
    whole = prompts.render_conversations(turns, part_turns=4).orderBy("part").collect()
    assert [(r.part, r.n_turns) for r in whole] == [(0, 2), (2, 1)]
    assert "\n".join(r.text for r in whole) == want + "\n<|user|>\nmore<|end|>"


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_pairs_across_blocks(spark, block):
    turns = [(c, t, "user" if (t + c) % 3 else "assistant", f"{c}:{t}") for c in range(5) for t in range(0, 40, c + 1)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {tuple(r) for r in prompts.question_answer_pairs(df, block).collect()}
    want = set()
    for c in range(5):
        own = sorted(t for t in turns if t[0] == c)
        want |= {(c, a[1], a[3], b[3]) for a, b in zip(own, own[1:]) if a[2] == "user" and b[2] == "assistant"}
    assert got == want


def test_preview_and_shuffle(spark):
    rows = spark.createDataFrame([(i, "q" * 130, "a" * 120) for i in range(20)], "id long, q string, a string")
    shown = ordering.preview(rows, "q", "a", 3, "id").collect()
    assert len(shown) == 1 and shown[0].question == "q" * 120 + "…" and shown[0].answer == "a" * 120
    first, again = (ordering.seeded_shuffle(rows, 3, "id").select("id").collect() for _ in range(2))
    other = ordering.seeded_shuffle(rows, 4, "id").select("id").collect()
    assert first == again and first != other and sorted(first) == sorted(other)
    assert first[0].id == shown[0].id


def test_multimodal_table_keeps_the_image(spark):
    rows = spark.createDataFrame([(1, bytearray(b"x"), "cap"), (2, None, " ")], "i int, photo binary, caption string")
    out = prompts.prompt_table(rows, keys=["i"]).collect()
    assert [(r.i, bytes(r.image), r.text) for r in out] == [(1, b"x", "cap")]


def test_test_tables(spark):
    tables = load_tables(spark, "/root/testdata/sf0.001")
    found = {r.table_name: r.task for r in roles.detect_tasks(roles.column_catalog(spark, tables)).collect()}
    assert {t for t, task in found.items() if task} == {"documents", "conversations", "benchmark"}
    assert set(found.values()) == {"causal", None}


def test_catalog_covers_every_task():
    assert {task for task, *_ in fv.TASK_CATALOG} == set(fv.TASK_ORDER)
