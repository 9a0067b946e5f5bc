"""Text cleaning as Column -> Column steps.

Every step is usable alone; :func:`clean_text` puts them together for one of
the four modes.  The order of the steps is part of the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv

Step = Callable[[Column], Column]
MODES = ("math", "latex", "code", "other")


def bind(value: Column, body: Step) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def rewrite(pattern: str, replacement: str = "") -> Step:
    """A step that replaces every match of ``pattern``."""
    return lambda text: F.regexp_replace(text, F.lit(pattern), F.lit(replacement))


def chain(*steps: Step) -> Step:
    """The steps one after the other."""
    def run(text: Column) -> Column:
        for step in steps:
            text = step(text)
        return text
    return run


def gate(needed: Callable[[Column], Column], *steps: Step) -> Step:
    """Run ``steps`` only on values for which ``needed`` holds.

    ``needed`` must be true whenever one of the steps could change the value;
    it is a cheap test that spares most rows a row of regex passes.
    """
    inner = chain(*steps)
    return lambda text: bind(text, lambda t: F.when(needed(t), inner(t)).otherwise(t))


def has(*literals: str) -> Callable[[Column], Column]:
    """True where the value contains one of the literals."""
    return lambda text: reduce(or_, [text.contains(literal) for literal in literals])


def has_non_ascii(text: Column) -> Column:
    return F.octet_length(text) > F.length(text)


def has_any_case(*literals: str) -> Callable[[Column], Column]:
    """True where the value may contain one of the ASCII literals in some case."""
    found, folding = has(*[literal.lower() for literal in literals]), has(*fv.FOLDS_TO_ASCII)
    return lambda text: bind(F.lower(text), found) | folding(text)


# --- the steps ----------------------------------------------------------------

def to_text(value: Column) -> Column:
    """Null becomes the empty string; anything else its string form."""
    return F.coalesce(value.cast("string"), F.lit(""))


def answer_text(df: DataFrame, column: str) -> Column:
    """A column as text: string lists by line, nested values as JSON."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(f"`{column}`")
    if kind == "array<string>":
        return F.array_join(value, "\n")
    if kind.startswith(("struct", "array", "map")):
        return F.to_json(value)
    return value.cast("string")


def strip(text: Column) -> Column:
    """Remove white space, Unicode kinds included, from both ends."""
    return F.btrim(text, F.lit(fv.SPACE_CHARS))


def unbox_whole(text: Column) -> Column:
    """The contents of a value that is one boxed answer and nothing else."""
    unwrap = rewrite(fv.BOXED_INNER, "$1")

    def body(t: Column) -> Column:
        inner = strip(unwrap(F.regexp_extract(strip(t), fv.BOXED_WHOLE, 1)))
        return F.when(strip(t).rlike(fv.BOXED_WHOLE), inner).otherwise(t)
    return gate(has("\\boxed{"), body)(text)


def flatten_breaks(text: Column) -> Column:
    """Runs of line breaks, tabs and their escaped forms become one space."""
    plain, escaped = rewrite(fv.PLAIN_BREAKS, " "), rewrite(fv.LINE_BREAKS, " ")
    return bind(text, lambda t: F.when(t.contains("\\\\"), escaped(t)).otherwise(plain(t)))


drop_markup_noise = gate(has("#", "*", "_", "`", "&", "!!", "!?", "?!", "??"), rewrite(fv.MARKUP_NOISE))
unwrap_math_text = rewrite(fv.MATH_WRAPPERS, "$1")
unwrap_inline_math = rewrite(fv.DOLLAR_INLINE, "$1")
space_out_tex = rewrite(fv.TEX_SPACING, " ")
collapse_spaces = gate(
    has("  ", *[c for c in fv.SPACE_CHARS if c != " "]), rewrite(fv.SPACE_RUN, " ")
)
drop_inline_math = rewrite(fv.PRICE_OR_MATH, "$1")
drop_delimited_tex = rewrite(fv.TEX_DELIMITED)
drop_roman_spans = rewrite(fv.ROMAN_SPAN)
drop_environments = rewrite(fv.TEX_ENVIRONMENT)
drop_tags = rewrite(fv.ANGLE_TAG)
unbox_anywhere = rewrite(fv.BOXED_ANYWHERE, "$1")
drop_role_markers = rewrite(fv.ROLE_MARKER)
drop_answer_marker = rewrite(fv.ANSWER_MARKER)
drop_brace_templates = rewrite(fv.BRACE_TEMPLATE)
drop_pipe_tokens = rewrite(fv.PIPE_TOKEN)
drop_header_lines = rewrite(fv.HEADER_LINE)
drop_shop_tags = rewrite(f"(?iu){fv.WORD_EDGE}(?:{fv.SHOP_TAGS}){fv.WORD_EDGE}")
drop_starred_spans = rewrite(fv.DOUBLE_STAR)
drop_invisible = rewrite(fv.INVISIBLE)
drop_media_placeholders = rewrite(fv.MEDIA_PLACEHOLDER)
drop_trash_placeholder = rewrite(fv.TRASH_PLACEHOLDER)
drop_emoji = gate(
    lambda t: t.rlike(fv.EMOJI_REACH), rewrite(rf"{fv.EMOJI_KEYCAP}|{fv.EMOJI_CLASS}\ufe0f?")
)
drop_emoji_keycaps = rewrite(fv.EMOJI_KEYCAP)
drop_non_ascii = rewrite(fv.NON_ASCII)


def drop_phrases(phrases: Sequence[str] = tuple(fv.WEB_PHRASES)) -> Step:
    """Delete whole-word phrases in any letter case."""
    words = "|".join(_quote(p) for p in phrases)
    return rewrite(f"(?iu){fv.WORD_EDGE}(?:{words}){fv.WORD_EDGE}")


def ascii_operators(text: Column) -> Column:
    """TeX operator names to ASCII signs, also as a prefix of longer names."""
    for name, sign in fv.TEX_OPERATORS:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def plain_punctuation(text: Column) -> Column:
    """Curly quotes, dashes and arrows to ASCII."""
    text = F.translate(text, fv.TYPOGRAPHIC_FROM, fv.TYPOGRAPHIC_TO)
    for arrow, plain in fv.ARROWS:
        text = F.replace(text, F.lit(arrow), F.lit(plain))
    return text


def _quote(literal: str) -> str:
    return re.sub(r"([\\\[\](){}.*+?^$|])", r"\\\1", literal)


def shortest_literals(literals: Iterable[str]) -> list[str]:
    """The literals that no other listed literal is part of.

    A value holds one of the list exactly when it holds one of these.
    """
    unique = sorted(set(literals), key=lambda s: (len(s), s))
    kept: list[str] = []
    for literal in unique:
        if not any(short in literal for short in kept):
            kept.append(literal)
    return kept


def blank_if_listed(literals: Sequence[str]) -> Step:
    """The empty string where the value holds one of the literals."""
    kept = shortest_literals(literals)
    if not kept:
        return lambda text: text
    listed = has(*kept)
    return lambda text: bind(text, lambda t: F.when(listed(t), F.lit("")).otherwise(t))


# --- the cleaner --------------------------------------------------------------

def cleaning_steps(
    mode: str = "math",
    preserve: Iterable[str] = (),
    denylist: Sequence[str] = tuple(fv.DENYLIST),
    phrases: Sequence[str] = tuple(fv.WEB_PHRASES),
    emoji: bool = True,
) -> list[Step]:
    """The ordered steps of one mode.

    ``preserve={"latex", "code"}`` keeps what both modes keep; a single
    preserved kind is the mode of that name.
    """
    kept = set(preserve)
    if kept:
        unknown = kept - {"latex", "code"}
        if unknown:
            raise ValueError(f"cannot preserve {sorted(unknown)}")
    elif mode not in MODES:
        raise ValueError(f"unknown cleaning mode {mode!r}")
    else:
        kept = {mode} & {"latex", "code"}
    math = mode == "math" and not kept
    layout = "code" in kept
    tex = math or "latex" in kept
    any_unicode = bool(kept)

    steps: list[Step] = [to_text, unbox_whole]
    if layout:
        steps += [strip]
    else:
        steps += [flatten_breaks, strip, drop_markup_noise]
    if math:
        steps += [
            gate(has("\\"), unwrap_math_text),
            gate(has("$"), unwrap_inline_math),
            gate(has("\\"), ascii_operators, space_out_tex),
            collapse_spaces, strip,
        ]
    listed_words = [drop_phrases(phrases)] if phrases else []
    listed_words.append(drop_shop_tags)
    if all(phrase.isascii() for phrase in phrases):
        listed_words = [gate(has_any_case(*phrases, *fv.SHOP_WORDS), *listed_words)]
    formulas = [] if tex else [drop_inline_math, drop_delimited_tex, drop_roman_spans]
    signs = ["\\", "<", "[", "{{", "#"] + ([] if tex else ["$"])
    steps += [
        gate(
            has(*signs), *formulas, drop_environments, drop_tags, unbox_anywhere,
            drop_role_markers, drop_answer_marker, drop_brace_templates,
            drop_pipe_tokens, drop_header_lines,
        ),
        *listed_words,
        gate(has("**"), drop_starred_spans),
        gate(has_non_ascii, drop_invisible),
        gate(
            has("["), drop_media_placeholders,
            *([] if "latex" in kept else [drop_trash_placeholder]),
        ),
    ]
    if any_unicode:
        exotic = [plain_punctuation] + ([drop_emoji] if emoji else [])
    else:
        exotic = [plain_punctuation] + ([drop_emoji_keycaps] if emoji else []) + [drop_non_ascii]
        denylist = [literal for literal in denylist if literal.isascii()]
    steps += [gate(has_non_ascii, *exotic), blank_if_listed(denylist), strip]
    return steps


def clean_text(text: Column, mode: str = "math", **options) -> Column:
    """Clean ``text``; see :func:`cleaning_steps` for the options."""
    return chain(*cleaning_steps(mode, **options))(text)


def words(text: Column) -> Column:
    """White-space tokens of a text, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), fv.SPACE + "+"), lambda w: w != "")


def keep_nonblank(df: DataFrame, text: Column, name: str = "text") -> DataFrame:
    """Add ``text`` as a column and drop the rows where it is blank.

    A plain filter would be pushed below the projection and evaluate the whole
    cleaning chain a second time.  Exploding a list of at most one value holds
    the filter and the column in one place.
    """
    kept = F.filter(F.array(text), lambda t: strip(t) != "")
    return df.withColumn(name, F.explode(kept))


def add_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that later steps may use many times."""
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*others, F.inline(packed))
