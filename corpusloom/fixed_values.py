"""Fixed values.

Everything in this file must equal the published behaviour for results to come
out right: column aliases, phrase lists, literals, constants and the patterns
of the text cleaner (written in the Java regex dialect).  Nothing here is
logic; every list is also the default of a parameter.
"""

# --- task catalog: (task, role, required, aliases in order of preference) ----

TASK_CATALOG = [
    ("sft", "chosen", True, [
        "response", "chosen", "answer", "answers", "completion", "output",
        "solution", "expected_answer", "long_answer", "messages", "summary"]),
    ("sft", "question", False, [
        "instruction", "question", "prompt", "input", "query", "context",
        "problem", "document"]),
    ("causal", "chosen", True, ["prompt", "text"]),
    ("chat", "question", True, ["messages"]),
    ("multimodal", "image", True, [
        "image", "img", "pixel", "photo", "image_path", "picture"]),
    ("multimodal", "chosen", True, [
        "answer", "response", "chosen", "caption", "completion", "output",
        "description", "label"]),
    ("multimodal", "question", False, [
        "question", "prompt", "instruction", "query", "text"]),
]
TASK_ORDER = ["sft", "causal", "chat", "multimodal"]
ROLES = ["question", "chosen", "rejected", "image"]

# --- literals that blank a whole field ---------------------------------------

DENYLIST = [
    "embedreportprint", "cloneembedreport", "rawdownload", "printrawdownload",
    "reportprintclone", "embedreport", "printclone", "guiActive",
    "guiActiveUnfocused", "externalToEVA", "externalToEVAOnly",
    "PsyNetMessage", "vesselType", "activeRadarLock", "unfocusedRange",
    "targetType", "guiIcon", "stockLegacySensor", "KSPField", "persistent",
    "ÃÂ", "\ufffd", "Ã¢", "â€™", "â€œ", "â€", "â€“", "Ã¼", "Ã¶", "ÃŸ",
    "[REJECTED ANSWER PLACEHOLDER]", "[PLACEHOLDER]", "[DUMMY]", "[INSERT]",
    "Traceback (most recent call last):", "NullPointerException",
    "undefined is not a function", "at com.", "You are a helpful assistant.",
    "LanguageModelOutput", "<|eot|>", "<unk>",
]

# --- characters ---------------------------------------------------------------

# The 29 code points that count as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WORD = r"[\p{L}\p{N}_]"
WORD_EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Other letters that match an ASCII letter when case is ignored.
FOLDS_TO_ASCII = "ſ\u212aıİ"

TYPOGRAPHIC_FROM = "“”‘’–—"
TYPOGRAPHIC_TO = "\"\"''--"
ARROWS = [("→", "->"), ("←", "<-")]

# Unicode Emoji=Yes code points above ASCII, as ranges (public Unicode data).
EMOJI_CLASS = (
    r"[\xa9\xae\u203c\u2049\u2122\u2139\u2194-\u2199\u21a9\u21aa\u231a\u231b"
    r"\u2328\u23cf\u23e9-\u23f3\u23f8-\u23fa\u24c2\u25aa\u25ab\u25b6\u25c0"
    r"\u25fb-\u25fe\u2600-\u2604\u260e\u2611\u2614\u2615\u2618\u261d\u2620"
    r"\u2622\u2623\u2626\u262a\u262e\u262f\u2638-\u263a\u2640\u2642"
    r"\u2648-\u2653\u265f\u2660\u2663\u2665\u2666\u2668\u267b\u267e\u267f"
    r"\u2692-\u2697\u2699\u269b\u269c\u26a0\u26a1\u26a7\u26aa\u26ab\u26b0\u26b1"
    r"\u26bd\u26be\u26c4\u26c5\u26c8\u26ce\u26cf\u26d1\u26d3\u26d4\u26e9\u26ea"
    r"\u26f0-\u26f5\u26f7-\u26fa\u26fd\u2702\u2705\u2708-\u270d\u270f\u2712"
    r"\u2714\u2716\u271d\u2721\u2728\u2733\u2734\u2744\u2747\u274c\u274e"
    r"\u2753-\u2755\u2757\u2763\u2764\u2795-\u2797\u27a1\u27b0\u27bf\u2934\u2935"
    r"\u2b05-\u2b07\u2b1b\u2b1c\u2b50\u2b55\u3030\u303d\u3297\u3299"
    r"\x{1f004}\x{1f0cf}\x{1f170}\x{1f171}\x{1f17e}\x{1f17f}\x{1f18e}"
    r"\x{1f191}-\x{1f19a}\x{1f1e6}-\x{1f1ff}\x{1f201}\x{1f202}\x{1f21a}\x{1f22f}"
    r"\x{1f232}-\x{1f23a}\x{1f250}\x{1f251}\x{1f300}-\x{1f321}"
    r"\x{1f324}-\x{1f393}\x{1f396}\x{1f397}\x{1f399}-\x{1f39b}"
    r"\x{1f39e}-\x{1f3f0}\x{1f3f3}-\x{1f3f5}\x{1f3f7}-\x{1f4fd}"
    r"\x{1f4ff}-\x{1f53d}\x{1f549}-\x{1f54e}\x{1f550}-\x{1f567}\x{1f56f}\x{1f570}"
    r"\x{1f573}-\x{1f57a}\x{1f587}\x{1f58a}-\x{1f58d}\x{1f590}\x{1f595}\x{1f596}"
    r"\x{1f5a4}\x{1f5a5}\x{1f5a8}\x{1f5b1}\x{1f5b2}\x{1f5bc}"
    r"\x{1f5c2}-\x{1f5c4}\x{1f5d1}-\x{1f5d3}\x{1f5dc}-\x{1f5de}\x{1f5e1}"
    r"\x{1f5e3}\x{1f5e8}\x{1f5ef}\x{1f5f3}\x{1f5fa}-\x{1f64f}"
    r"\x{1f680}-\x{1f6c5}\x{1f6cb}-\x{1f6d2}\x{1f6d5}-\x{1f6d7}"
    r"\x{1f6dc}-\x{1f6e5}\x{1f6e9}\x{1f6eb}\x{1f6ec}\x{1f6f0}"
    r"\x{1f6f3}-\x{1f6fc}\x{1f7e0}-\x{1f7eb}\x{1f7f0}\x{1f90c}-\x{1f93a}"
    r"\x{1f93c}-\x{1f945}\x{1f947}-\x{1f9ff}\x{1fa70}-\x{1faff}]"
)
# Covers the class above and the keycap mark.
EMOJI_REACH = r"[\xa9\xae\u203c-\u3299\x{1f004}-\x{1faff}]"
EMOJI_KEYCAP = r"[0-9#*]\ufe0f?\u20e3"

# --- cleaner patterns ---------------------------------------------------------

BOXED_WHOLE = (
    rf'\A[(\[{{"]?{SPACE}*\$*\\boxed\{{([^}}]*)\}}\$*{SPACE}*[)\]}}"]?\.?{SPACE}*\z'
)
BOXED_INNER = r"\\(?:text|mathrm)\{([^}]*)\}"
PLAIN_BREAKS = r"[\n\r\t]+"
LINE_BREAKS = r"(?:[\n\r\t]++|\\\\[ntr])++"
MARKUP_NOISE = r"[#*_`]+|[!?]{2,}|&[a-z]+;"
MATH_WRAPPERS = r"\\(?:mathrm|text|operatorname)\{([^}]*)\}"
DOLLAR_INLINE = r"(?<!\$)\$([^$]+)\$(?!\$)"
TEX_OPERATORS = [
    (r"\cdot", "*"), (r"\times", "*"), (r"\le", "<="), (r"\ge", ">="),
    (r"\neq", "!="), (r"\pm", "+/-"), (r"\div", "/"),
    (r"\triangle", "triangle"), (r"\quad", " "),
]
TEX_SPACING = rf"\\(?:,|;|:|!|quad|qquad){SPACE}*"
SPACE_RUN = rf"{SPACE}{{2,}}"
# Group 1 is a plain price between dollars, which stays.
PRICE_OR_MATH = (
    r"(?<!\$)(?:(\$\p{Nd}[\p{Nd},]*+(?:\.\p{Nd}{1,2})?\$)(?!\$)"
    r"|\$(?:\\[^\n]|[^$\\])++\$(?!\$))"
)
# A delimited formula runs to the last closing delimiter of the text.
TEX_ROUND = (
    r"\\\((?:(?:[^\\]++|\\[^)])++\\\)|\\\)(?:[^\\]++|\\[^)])*+\\\))"
    r"(?:(?:[^\\]++|\\[^)])*+\\\))*+"
)
TEX_SQUARE = (
    r"\\\[(?:(?:[^\\]++|\\[^\]])++\\\]|\\\](?:[^\\]++|\\[^\]])*+\\\])"
    r"(?:(?:[^\\]++|\\[^\]])*+\\\])*+"
)
TEX_DELIMITED = f"(?:{TEX_ROUND})|(?:{TEX_SQUARE})"
ROMAN_SPAN = r"\\mathrm\{[^\n]*?\}"
TEX_ENVIRONMENT = r"(?s)\\begin\{[^}]+\}.*?\\end\{[^}]+\}"
ANGLE_TAG = r"<[^>]+>"
BOXED_ANYWHERE = r"\$*\\boxed\{([^}]*)\}\$*"
ROLE_MARKER = r"\[/?(?:INST|SYS|USER|ASSISTANT)\]"
ANSWER_MARKER = (
    rf"(?iu)\A{SPACE}*#{{3,6}}{SPACE}*(?:final{SPACE}*answer{SPACE}*:)?"
    rf"{SPACE}*(?:answer{SPACE}*:)?{SPACE}*"
)
BRACE_TEMPLATE = r"\{\{[^\n]*?\}\}"
PIPE_TOKEN = r"<\|[^\n]*?\|>"
HEADER_LINE = rf"(?<![^\n]){SPACE}*#{{1,6}}{SPACE}[^\n]*"
WEB_PHRASES = ["Click here", "Subscribe", "Follow us", "Advertisement"]
SHOP_WORDS = ["SKU", "ASIN", "MSRP", "Price"]
SHOP_TAGS = rf"SKU|ASIN|MSRP|Price:?{SPACE}*\$?\p{{Nd}}[\p{{Nd}},.]*"
DOUBLE_STAR = r"\*\*[^\n]*?\*\*"
INVISIBLE = r"[\u200b-\u200f\u202a-\u202e\u2060\ufeff]"
MEDIA_PLACEHOLDER = r"(?iu)\[(?:image|video|audio|figure)[^\]]*\]"
TRASH_PLACEHOLDER = r"\[TRASH\]"
NON_ASCII = r"[^\x00-\x7F]+"

# --- prompts and labels -------------------------------------------------------

PART_SEPARATOR = "\n\n"
INSTRUCTION_HEAD = "### Instruction:\n"
INPUT_HEAD = "### Input:\n"
RESPONSE_HEAD = "### Response:\n"
USER_MARK = "<|user|>"
IMAGE_MARK = "<|image_1|>"
END_MARK = "<|end|>"
ASSISTANT_MARK = "<|assistant|>"
PREVIEW_CHARS = 120
IGNORE_LABEL = -100
PAD_MULTIPLE = 8

# --- lengths and run plan -----------------------------------------------------

MIN_CAP, MAX_CAP = 128, 1024
FLOOR_SMALL, FLOOR_LARGE, FLOOR_SWITCH = 0.22, 0.18, 4000
RESTART_PRESSURE, LINEAR_PRESSURE = 0.18, 0.36
MIN_STOP_STEPS = 50
HARD_CAP_HIGH, HARD_CAP_LOW = 0.95, 0.65
MIN_WARMUP, WARMUP_FRACTION = 75, 0.01
GRAD_ACCUM, EPOCHS = 8, 1

# --- loss monitor, as used at call time --------------------------------------

MONITOR = {
    "exposure_floor": 0.18, "lr_fraction": 0.60, "window": 128, "beta": 0.90,
    "sigma_floor": 0.22, "min_drop": 0.04, "min_sigmas": 0.50,
    "slope_threshold": 0.010, "patience": 8, "cooldown": 3,
}
BEST_MARGIN = 1e-12
MAD_SCALE = 1.4826
