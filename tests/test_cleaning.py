"""Golden vectors of the text cleaner, derived by hand from its rules."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as tx

ALL = ("math", "latex", "code", "other")
VECTORS = [
    (ALL, None, ""),
    (ALL, "", ""),
    (ALL, "\\boxed{42}", "42"),
    (ALL, ' "$\\boxed{ 42 }$". ', "42"),
    (("math",), "\\boxed{\\text{yes}}", "\\text{yes"),  # the first brace closes the box
    (("math",), "\\boxed{5} is it", "5 is it"),
    (("other",), "so $\\boxed{7}$", "so"),  # inline math goes before boxes are opened
    (("math",), "a \\le b and c \\ge d", "a = d"),
    (("math",), "\\left(x\\right)", "<=ft(x\\right)"),
    (("math",), "a \\geq b", "a >=q b"),
    (("math",), "costs $5 and $10", "costs 5 and 10"),
    (("code", "other"), "costs $5 and $10", "costs 10"),
    (("latex",), "costs $5 and $10", "costs $5 and $10"),
    (("code", "other"), "fee is $5.00$ today", "fee is $5.00$ today"),
    (("code", "other"), "fee is $5.001$ today", "fee is  today"),
    (("code", "other"), "$1,200$ and $x$ then $y$", "$1,200$ and  then"),
    (("math",), "fee is $5.00$ today", "fee is 5.00 today"),
    (ALL, "x $$y$$ z", "x $$y$$ z"),
    (("code",), "List<String> x", "List x"),
    (("code",), "# comment\nprint(1)", "print(1)"),
    (("code",), "#\nnext\nkeep", "keep"),
    (("code",), "####### seven", ""),  # six go as an answer marker, the rest is a header
    (("code",), "x\n####### seven", "x\n####### seven"),
    (("math", "latex", "other"), "line1\n\nline2\ttab", "line1 line2 tab"),
    (("code",), "line1\n\nline2\ttab", "line1\n\nline2\ttab"),
    (("math", "latex", "other"), "a\\\\nb", "a b"),
    (("latex",), "a\\nb", "a\\nb"),
    (("math", "latex", "other"), "**bold** text", "bold text"),
    (("code",), "**bold** text", "text"),
    (("math", "latex", "other"), "wow!!! why?!", "wow why"),
    (("math",), "A &amp; B", "A B"),
    (("other", "latex"), "A &amp; B", "A  B"),
    (("other",), "keep &#39; this &AMP; that", "keep &39; this &AMP; that"),
    (("latex",), "x_1 + \\alpha", "x1 + \\alpha"),
    (("math",), "\\mathrm{AB} \\text{cd} \\operatorname{ef}", "AB cd ef"),
    (("other",), "\\mathrm{AB} \\text{cd}", "\\text{cd}"),
    (("math",), "a\\cdot b\\times c\\neq d\\pm e\\div f", "a* b* c!= d+/- e/ f"),
    (("math",), "\\triangle ABC\\quad x", "triangle ABC x"),
    (("math",), "a\\,b\\; c\\!d", "a b c d"),
    (ALL, "\\begin{align}x\n=1\\end{align} ok", "ok"),
    (ALL, "a<b>c</b>d", "acd"),
    (ALL, "[INST] hi [/INST]", "hi"),
    (ALL, "[inst] hi", "[inst] hi"),
    (("code",), "#### Final Answer: answer: 42", "42"),
    (("code",), "so #### 42", "so #### 42"),
    (("math",), "#### Final answer: 42", "Final answer: 42"),
    (ALL, "{{name}} hello", "hello"),
    (("math",), "Click here to subscribe now", "to  now"),
    (ALL, "Click hereafter, unsubscribe", "Click hereafter, unsubscribe"),
    (("math", "code"), "SKU 12 Price: $5,000 left", "12  left"),
    (("other",), "Price: 5,000abc", "000abc"),
    (ALL, "increasing prices", "increasing prices"),
    (ALL, "zero\u200bwidth\ufeff", "zerowidth"),
    (ALL, "see [Image: cat.png] here", "see  here"),
    (("math", "code", "other"), "[TRASH] x", "x"),
    (("latex",), "[TRASH] x", "[TRASH] x"),
    (ALL, "“quote” – it’s → ok ←", "\"quote\" - it's -> ok <-"),
    (("math", "other"), "café über", "caf ber"),
    (("latex", "code"), "café über", "café über"),
    (ALL, "hi 😀 there ☎️", "hi  there"),
    (ALL, "1\ufe0f\u20e3 go", "go"),
    (ALL, "You are a helpful assistant. Hello", ""),
    (ALL, "ends [DUMMY] x", ""),
    (("latex", "code"), "itâ€™s", ""),
    (("math", "other"), "itâ€™s", "its"),  # the non-ASCII letters are gone by then
    (ALL, "say <unk> twice", "say  twice"),
    (("code",), "`code` & [x]", "`code` & [x]"),
    (("other", "code"), "\\(a\\) b \\(c\\) d", "d"),  # up to the last closing delimiter
    (("other", "code"), "\\(\\) x", "\\(\\) x"),
    (("other", "code"), "\\(\\) x \\) y", "y"),
    (("other", "code"), "p \\[x\ny\\] z", "p  z"),
    (("latex",), "\\(a\\) b", "\\(a\\) b"),
    (ALL, "\xa0hi\u3000", "hi"),
    (("math",), "a\xa0\xa0b  c", "a b c"),
    (("code",), "\x1c x \x1f", "x"),
]


def cleaned(spark, texts, mode, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = rows.select("i", tx.clean_text(F.col("t"), mode, **options).alias("c")).collect()
    return [r["c"] for r in sorted(out)]


@pytest.mark.parametrize("mode", ALL)
def test_golden_vectors(spark, mode):
    wanted = [(given, want) for modes, given, want in VECTORS if mode in modes]
    got = cleaned(spark, [given for given, _ in wanted], mode)
    wrong = [(given, want, out) for (given, want), out in zip(wanted, got) if want != out]
    assert not wrong


def test_preserving_both_keeps_layout_and_formulas(spark):
    given = "x_1 $a$ é\n  indented\n[TRASH]"
    assert cleaned(spark, [given], "math", preserve={"latex", "code"}) == [given]


def test_one_preserved_kind_is_its_mode(spark):
    given = ["**b** $x$ é\n# h"]
    assert cleaned(spark, given, "math", preserve={"code"}) == cleaned(spark, given, "code")


def test_unknown_modes_are_refused():
    with pytest.raises(ValueError):
        tx.cleaning_steps("latex+code")
    with pytest.raises(ValueError):
        tx.cleaning_steps(preserve={"html"})


def test_own_denylist_and_phrases(spark):
    options = dict(denylist=["secret"], phrases=["buy now"])
    got = cleaned(spark, ["a secret", "Click here", "Buy Now ok"], "other", **options)
    assert got == ["", "Click here", "ok"]


def test_long_values_do_not_exhaust_the_stack(spark):
    many = 200_000
    given = [
        "$" + "a" * many + "$ end", "\\(" + "\\x" * many + "\\) end", "\\[" + "\\]" * many + " end",
        "\\\\n" * many + "end", "#" * many + " end", "<" + "b" * many + "> end", "{{" + "c" * many + "}} end",
    ]
    got = cleaned(spark, given, "other")
    assert got == ["end"] * len(given)


def test_clean_text_has_no_other_letters_left(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for mode in ("math", "other"):
        text = tx.clean_text(F.col("text"), mode)
        assert rows.filter(tx.has_non_ascii(text)).count() == 0


def test_gates_change_nothing(spark):
    """A gated step equals the bare pattern on texts with and without matches."""
    from corpusloom import fixed_values as fv

    pairs = [
        (tx.drop_markup_noise, tx.rewrite(fv.MARKUP_NOISE)), (tx.collapse_spaces, tx.rewrite(fv.SPACE_RUN, " ")),
        (tx.flatten_breaks, tx.rewrite(fv.LINE_BREAKS, " ")),
        (
            tx.gate(tx.has_any_case(*fv.WEB_PHRASES, *fv.SHOP_WORDS), tx.drop_phrases(), tx.drop_shop_tags),
            tx.chain(tx.drop_phrases(), tx.drop_shop_tags),
        ),
        (tx.drop_emoji, tx.rewrite(rf"{fv.EMOJI_KEYCAP}|{fv.EMOJI_CLASS}\ufe0f?")),
    ]
    texts = [t for _, t, _ in VECTORS if t] + ["ſku 1", "\u212aſkU cl\u0131ck here \u212a", "SUBSCRIBE", "a\x0b\x0bc", "©x", "#️⃣"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for gated, bare in pairs:
        assert rows.filter(gated(F.col("t")) != bare(F.col("t"))).count() == 0


def test_shortest_literals():
    assert tx.shortest_literals(["abc", "b", "xyz", "b"]) == ["b", "xyz"]


def test_keep_nonblank_and_answer_text(spark):
    rows = spark.createDataFrame(
        [(1, ["a", "b"], (2, "x")), (2, [], (3, "y"))], "i int, l array<string>, s struct<n:int,t:string>"
    )
    assert [r.text for r in tx.keep_nonblank(rows, tx.answer_text(rows, "l")).collect()] == ["a\nb"]
    assert rows.select(tx.answer_text(rows, "s").alias("t")).first().t == '{"n":2,"t":"x"}'
    assert rows.select(tx.answer_text(rows, "i").alias("t")).first().t == "1"
