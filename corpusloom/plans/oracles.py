"""The same queries in DuckDB SQL, for comparison.

DuckDB's regex engine has no look-around and no possessive repeats, so the
patterns are written again here in its dialect.
"""

from __future__ import annotations

import re
from types import SimpleNamespace

from corpusloom import fixed_values as fv
from corpusloom.operators.tokens import RESERVED, UNK
from corpusloom.plans import queries as q

SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {text(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {text(pattern)}, {text(by)}, 'g')"


def steady(x: str, digits: int = 4) -> str:
    return f"round({x} + {q.OFF_TIES / 10 ** digits!r}, {digits})"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {text(SPACE + '+')}), lambda w: w <> '')"


def braces(java: str) -> str:
    r"""Four-digit escapes as ``\x{…}``."""
    return re.sub(r"\\u([0-9a-f]{4})|\\x([0-9a-f]{2})", lambda m: rf"\x{{{m[1] or m[2]}}}", java)


def cleaning(mode: str, denied: list[str] = fv.DENYLIST) -> list[str]:
    """The steps of a mode as SQL expressions over a column ``t``."""
    boxed = rf'^[(\[{{"]?{SPACE}*\$*\\boxed\{{([^}}]*)\}}\$*{SPACE}*[)\]}}"]?\.?{SPACE}*$'
    inner = sub(f"regexp_extract({strip('t')}, {text(boxed)}, 1)", r"\\(?:text|mathrm)\{([^}]*)\}", r"\1")
    steps = [
        "coalesce(t, '')",
        f"CASE WHEN regexp_matches({strip('t')}, {text(boxed)}) THEN {strip(inner)} ELSE t END",
    ]
    pair, lone = "chr(1) || chr(1)", r"\$([^$\x01]+)\$"
    hide = f"replace(replace(t, '$$', {pair}), chr(1) || '$', {pair})"
    show = "replace(t, chr(1), '$')"
    if mode == "code":
        steps.append(strip("t"))
    else:
        steps += [
            sub("t", r"(?:[\n\r\t]+|\\\\[ntr])+", " "), strip("t"),
            sub("t", r"[#*_`]+|[!?]{2,}|&[a-z]+;"),
        ]
    if mode == "math":
        steps += [
            sub("t", r"\\(?:mathrm|text|operatorname)\{([^}]*)\}", r"\1"), hide,
            sub("t", lone, r"\1"), show,
            *[f"replace(t, {text(name)}, {text(sign)})" for name, sign in fv.TEX_OPERATORS],
            sub("t", rf"\\(?:,|;|:|!|quad|qquad){SPACE}*", " "), sub("t", rf"{SPACE}{{2,}}", " "), strip("t"),
        ]
    if mode in ("code", "other"):
        steps += [
            hide,
            sub("t", r"(\$\p{Nd}[\p{Nd},]*(?:\.\p{Nd}{1,2})?\$)|\$(?:\\[^\n]|[^$\\\x01])+\$", r"\1"), show,
            sub("t", r"(?s)\\\((?:\\.|[^\\])+\\\)|\\\[(?:\\.|[^\\])+\\\]"),
            sub("t", r"\\mathrm\{[^\n]*?\}"),
        ]
    steps += [
        sub("t", r"(?s)\\begin\{[^}]+\}.*?\\end\{[^}]+\}"), sub("t", r"<[^>]+>"),
        sub("t", r"\$*\\boxed\{([^}]*)\}\$*", r"\1"), sub("t", r"\[/?(?:INST|SYS|USER|ASSISTANT)\]"),
        sub("t", rf"(?i)\A{SPACE}*#{{3,6}}{SPACE}*(?:final{SPACE}*answer{SPACE}*:)?{SPACE}*(?:answer{SPACE}*:)?{SPACE}*"),
        sub("t", r"\{\{[^\n]*?\}\}"), sub("t", r"<\|[^\n]*?\|>"),
        sub("t", rf"(?m)^{SPACE}*#{{1,6}}{SPACE}[^\n]*$"),
        sub("t", r"(?i)\b(?:" + "|".join(fv.WEB_PHRASES) + r")\b"),
        sub("t", rf"(?i)\b(?:SKU|ASIN|MSRP|Price:?{SPACE}*\$?\d[\d,.]*)\b"),
        sub("t", r"\*\*[^\n]*?\*\*"), sub("t", braces(fv.INVISIBLE)),
        sub("t", r"(?i)\[(?:image|video|audio|figure)[^\]]*\]"),
    ]
    if mode != "latex":
        steps.append(sub("t", r"\[TRASH\]"))
    steps += [
        f"translate(t, {text(fv.TYPOGRAPHIC_FROM)}, {text(fv.TYPOGRAPHIC_TO)})",
        *[f"replace(t, {text(arrow)}, {text(plain)})" for arrow, plain in fv.ARROWS],
        sub("t", braces(rf"{fv.EMOJI_KEYCAP}|{fv.EMOJI_CLASS}\ufe0f?")),
    ]
    if mode in ("math", "other"):
        steps.append(sub("t", r"[^\x00-\x7F]+"))
    found = " OR ".join(f"contains(t, {text(x)})" for x in denied)
    return [*steps, f"CASE WHEN {found} THEN '' ELSE t END", strip("t")]


def cleaned(source: str, name: str, mode: str, denied: list[str] = fv.DENYLIST) -> str:
    """CTEs that end in ``name``: ``source`` with its column ``t`` cleaned."""
    parts, last = [], source
    steps = cleaning(mode, denied)
    for at, step in enumerate(steps):
        this = name if at == len(steps) - 1 else f"{name}_{at}"
        parts.append(f"{this} AS (SELECT * REPLACE ({step} AS t) FROM {last})")
        last = this
    return ",\n".join(parts)


# --- text ---------------------------------------------------------------------

DOCS = "raw AS (SELECT doc_id, source, text AS t FROM documents)"
DENIED = fv.DENYLIST + q.EXTRA_DENIED


def clean_documents(mode: str) -> str:
    return f"WITH {DOCS}, {cleaned('raw', 'c', mode)} SELECT doc_id, t AS text FROM c"


CLEAN_PAGES = (
    f"WITH raw AS (SELECT page_id, html AS t FROM pages), {cleaned('raw', 'c', 'other')} "
    "SELECT page_id, t AS text FROM c"
)
STRIP_TAGS = f"SELECT page_id, {sub('html', '<[^>]+>')} AS text FROM pages"
LITERALS = ", ".join(f"({text(x)})" for x in DENIED)
DENYLIST_HITS = f"""
SELECT source, literal, count(*) AS n_hits FROM documents, (VALUES {LITERALS}) AS l(literal)
WHERE contains(text, literal) GROUP BY source, literal"""
NONEMPTY = f"WITH {DOCS}, {cleaned('raw', 'c', 'other', DENIED)} SELECT doc_id, t AS text FROM c WHERE {strip('t')} <> ''"
RETENTION = f"""WITH {DOCS}, {cleaned('raw', 'c', 'other', DENIED)}
SELECT source, count(*) AS n_rows, count(*) FILTER ({strip('t')} <> '') AS n_kept FROM c GROUP BY source"""

# --- roles, ledger, order -----------------------------------------------------

ALIASES = ", ".join(
    f"({text(task)}, {fv.TASK_ORDER.index(task)}, {text(role)}, {str(required).lower()}, {text(alias)}, {rank})"
    for task, role, required, aliases in fv.TASK_CATALOG for rank, alias in enumerate(aliases)
)
ROWS_PER_TABLE = " UNION ALL ".join(
    f"SELECT {text(t)} AS table_name, count(*) AS n_rows, "
    + (f"count(*) FILTER ({strip('text')} <> '')" if t in ("documents", "benchmark", "conversations") else "0::BIGINT")
    + f" AS n_answered FROM {t}"
    for t in q.TEST_TABLES
)
ROLE_CTES = f"""
aliases(task, task_rank, role, required, alias, alias_rank) AS (VALUES {ALIASES}),
cols AS (SELECT DISTINCT table_name, column_name FROM information_schema.columns
         WHERE table_name IN ({', '.join(text(t) for t in q.TEST_TABLES)})),
hits AS (SELECT table_name, column_name, a.* FROM cols JOIN aliases a ON lower(column_name) = alias),
met AS (SELECT table_name, task, task_rank, count(DISTINCT role) AS n FROM hits WHERE required GROUP BY ALL),
needed AS (SELECT task, count(DISTINCT role) AS n FROM aliases WHERE required GROUP BY task),
tasks AS (SELECT table_name, arg_min(m.task, CASE WHEN m.task = 'multimodal' THEN -2 ELSE task_rank END) AS task
          FROM met m JOIN needed d ON m.task = d.task AND m.n = d.n GROUP BY table_name),
sizes AS ({ROWS_PER_TABLE})"""
DETECT = f"WITH {ROLE_CTES} SELECT s.table_name, t.task, s.n_rows FROM sizes s LEFT JOIN tasks t USING (table_name)"
ROLE_COLUMNS = ", ".join(
    f"arg_min(h.column_name, h.alias_rank) FILTER (h.role = '{r}') AS {r}" for r in fv.ROLES
)
ROLE_MAP = f"""WITH {ROLE_CTES}
SELECT s.table_name, any_value(t.task) AS task, {ROLE_COLUMNS}, any_value(n_rows) AS n_rows,
       any_value(n_answered) AS n_answered
FROM sizes s LEFT JOIN tasks t USING (table_name) LEFT JOIN hits h ON h.table_name = t.table_name AND h.task = t.task
GROUP BY s.table_name"""
LEDGER = """
SELECT DISTINCT source AS name FROM documents
WHERE source NOT IN (SELECT source FROM documents WHERE contains(text, '@'))"""
SHUFFLE = f"SELECT doc_id, md5('{q.SEED}:' || doc_id) AS shuffle_key FROM documents"

# --- prompts ------------------------------------------------------------------

PAIRS = """
turns AS (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (SELECT conv_id, turn, text AS question, next_text AS answer FROM turns
          WHERE role = 'user' AND next_role = 'assistant')"""


def both_cleaned(mode: str) -> str:
    return f"""{PAIRS},
qs AS (SELECT conv_id, turn, question AS t FROM pairs), {cleaned('qs', 'qc', mode)},
ans AS (SELECT conv_id, turn, answer AS t FROM pairs), {cleaned('ans', 'ac', mode)},
both_parts AS (SELECT conv_id, turn, qc.t AS cq, ac.t AS ca FROM qc JOIN ac USING (conv_id, turn))"""


SFT_PAIRS = f"WITH {PAIRS} SELECT * FROM pairs"
SFT_PROMPT = f"""WITH {both_cleaned('math')}
SELECT conv_id, turn, cq || chr(10) || chr(10) || ca AS text FROM both_parts
WHERE {strip("cq || chr(10) || ca")} <> ''"""


def cut(x: str) -> str:
    return f"CASE WHEN length({x}) > {fv.PREVIEW_CHARS} THEN left({x}, {fv.PREVIEW_CHARS}) || '…' ELSE {x} END"


PREVIEW = f"""WITH {both_cleaned('math')}
SELECT conv_id, turn, {cut('cq')} AS question, {cut('ca')} AS answer FROM both_parts
ORDER BY md5('{q.SEED}:' || conv_id || ':' || turn), conv_id, turn LIMIT 1"""
MULTIMODAL = f"""WITH {both_cleaned('latex')}
SELECT p.conv_id, p.turn, concat_ws(chr(10) || chr(10), CASE WHEN {strip('question')} <> '' THEN cq END,
       CASE WHEN {strip('answer')} <> '' THEN ca END) AS text
FROM pairs p JOIN both_parts b ON p.conv_id = b.conv_id AND p.turn = b.turn"""
CHAT = f"""WITH raw AS (SELECT conv_id, turn, role, text AS t FROM conversations), {cleaned('raw', 'c', 'math')}
SELECT conv_id, count(*)::INTEGER AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || t || '{fv.END_MARK}', chr(10) ORDER BY turn) AS text
FROM c GROUP BY conv_id"""
INSTRUCTION = f"""WITH {PAIRS},
sys AS (SELECT conv_id, arg_min(text, turn) AS instruction FROM conversations WHERE role = 'system' GROUP BY conv_id),
raw AS (SELECT p.conv_id, p.turn,
  {text(fv.INSTRUCTION_HEAD)} || {strip('coalesce(instruction, question)')} || chr(10) || chr(10)
  || CASE WHEN instruction IS NOT NULL AND {strip('instruction')} <> '' AND {strip('question')} <> ''
          THEN {text(fv.INPUT_HEAD)} || {strip('question')} || chr(10) || chr(10) ELSE '' END
  || {text(fv.RESPONSE_HEAD)} || {strip('answer')} AS t
  FROM pairs p LEFT JOIN sys s ON p.conv_id = s.conv_id),
{cleaned('raw', 'c', 'code')} SELECT conv_id, turn, t AS text FROM c"""
VISION_TEXT = (
    f"'{fv.USER_MARK}' || chr(10) || '{fv.IMAGE_MARK}' || chr(10) || %s || '{fv.END_MARK}' || chr(10) "
    f"|| '{fv.ASSISTANT_MARK}' || chr(10) || %s"
)
VISION = f"WITH {PAIRS} SELECT conv_id, turn, {VISION_TEXT % (strip('question'), strip('answer'))} AS text FROM pairs"

# --- lengths ------------------------------------------------------------------

LENGTHS = f"lens AS (SELECT doc_id, lang, (len({words('text')}) + 1)::INTEGER AS length FROM documents)"
POINTS = ", ".join(
    f"floor(quantile_cont(length, {p}))::INTEGER AS {n}" for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
)
TOKEN_LENGTH = f"WITH {LENGTHS} SELECT doc_id, length FROM lens"
PERCENTILES = f"WITH {LENGTHS} SELECT lang, count(*) AS n_rows, {POINTS} FROM lens GROUP BY lang"
AUTO_LENGTH = f"""WITH {LENGTHS}, m AS (
SELECT lang, count(*) AS n_rows, {POINTS} FROM lens GROUP BY lang
UNION ALL SELECT 'all', count(*), {POINTS} FROM lens)
SELECT *, greatest({fv.MIN_CAP}, least({fv.MAX_CAP}, p95))::INTEGER AS max_length FROM m"""

# --- tokens and batches -------------------------------------------------------


def vocabulary(source: str, column: str = "text") -> str:
    reserved = ", ".join(text(x) for x in RESERVED)
    listed = ", ".join(f"({text(x)}, {i}::BIGINT)" for i, x in enumerate(RESERVED))
    return f"""
counted AS (SELECT token, count(*) AS n FROM (SELECT unnest({words(column)}) AS token FROM {source})
            WHERE token NOT IN ({reserved}) GROUP BY token),
vocab AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + {len(RESERVED) - 1} AS id FROM counted
          ORDER BY n DESC, token LIMIT {q.VOCABULARY}),
known AS (SELECT token, id FROM vocab UNION ALL SELECT * FROM (VALUES {listed}) AS r(token, id))"""


def encoded(source: str, key: str, column: str = "t", cap: str = "(SELECT v FROM cap)", bos: int = 1) -> str:
    """CTE ``coded``: key, ids and the length before the cut."""
    return f"""
toks AS (SELECT {key} AS key, {words(column)} AS w FROM {source}),
parts AS (SELECT key, unnest(w[1:({cap}) - {bos}]) AS token, generate_subscripts(w[1:({cap}) - {bos}], 1) AS pos FROM toks),
looked AS (SELECT key, list(coalesce(id, {UNK}) ORDER BY pos) AS ids FROM parts LEFT JOIN known USING (token) GROUP BY key),
coded AS (SELECT key, {'list_concat([1::BIGINT], coalesce(ids, []))' if bos else 'coalesce(ids, [])'} AS ids,
          (len(w) + {bos})::INTEGER AS length FROM toks LEFT JOIN looked USING (key))"""


def cap(source: str, column: str = "t", bos: int = 1) -> str:
    """CTE ``cap``: the derived length cap over ``source``."""
    return (f"cap AS (SELECT greatest({fv.MIN_CAP}, least({fv.MAX_CAP}, "
            f"floor(quantile_cont(len({words(column)}) + {bos}, 0.95))))::BIGINT AS v FROM {source})")


def ones(x: str) -> str:
    return f"list_transform({x}, lambda v: 1)"


def csv(x: str) -> str:
    return f"array_to_string({x}, ',')"


DOC_CODES = f"raw AS (SELECT doc_id, text AS t FROM documents), {vocabulary('documents')}, {cap('raw')}, {encoded('raw', 'doc_id')}"
PAIR_CODES = f"""{PAIRS},
raw AS (SELECT struct_pack(conv_id := conv_id, turn := turn) AS pair, {VISION_TEXT % ('question', 'answer')} AS t0 FROM pairs),
marked AS (SELECT pair, replace(replace(replace(replace(t0, '{fv.USER_MARK}', ' {fv.USER_MARK} '),
  '{fv.IMAGE_MARK}', ' {fv.IMAGE_MARK} '), '{fv.END_MARK}', ' {fv.END_MARK} '),
  '{fv.ASSISTANT_MARK}', ' {fv.ASSISTANT_MARK} ') AS t FROM raw),
{vocabulary('conversations')}, {cap('marked')}, {encoded('marked', 'pair')},
answered AS (SELECT key, ids, length,
  CASE WHEN list_contains(ids, 7) THEN list_transform(ids, lambda x, i:
    CASE WHEN i <= len(ids) - list_position(list_reverse(ids), 7) + 1 THEN -100 ELSE x END)
  ELSE ids END AS labels FROM coded)"""
VOCAB = f"WITH {vocabulary('documents')} SELECT token, n, id FROM vocab"
TOKENIZE = f"WITH {DOC_CODES} SELECT key AS doc_id, {csv('ids')} AS ids, length FROM coded"
LABELS = f"WITH {DOC_CODES} SELECT key AS doc_id, {csv(ones('ids'))} AS mask, {csv('ids')} AS labels FROM coded"
EXPORT = f"WITH {DOC_CODES} SELECT key AS doc_id, {csv('ids')} AS ids, {csv('ids')} AS labels, length FROM coded"
ANSWER_ONLY = f"WITH {PAIR_CODES} SELECT key.conv_id AS conv_id, key.turn AS turn, {csv('ids')} AS ids, {csv('labels')} AS labels FROM answered"
NONEMPTY_IDS = f"""WITH {DOCS}, {cleaned('raw', 'c', 'math', DENIED)}, {vocabulary('documents')}, {cap('c', bos=0)}, {encoded('c', 'doc_id', bos=0)}
SELECT source, count(*) AS n_rows, count(*) FILTER (len(ids) = 0) AS n_dropped
FROM coded JOIN c ON key = doc_id GROUP BY source"""


def batched(source: str, part_rows: int = 65536, bucket: str = "least(length // 64, 4095)",
            order: str = "length DESC, key", name: str = "batched", key: str = "key::VARCHAR") -> str:
    return f"""
{name}_b AS (SELECT *, ({bucket})::INTEGER AS bucket FROM {source}),
{name}_n AS (SELECT bucket, ceil(count(*) / {part_rows})::BIGINT AS parts FROM {name}_b GROUP BY bucket),
{name}_p AS (SELECT b.*, (('0x' || substr(md5({key}), 1, 8))::BIGINT % parts)::INTEGER AS part
             FROM {name}_b b JOIN {name}_n USING (bucket)),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY bucket, part ORDER BY {order}) - 1 AS rn FROM {name}_p),
{name} AS (SELECT * EXCLUDE (rn), (rn // {q.BATCH})::INTEGER AS batch, (rn % {q.BATCH})::INTEGER AS slot FROM {name}_r)"""


GROUPED = f"WITH {LENGTHS}, keyed AS (SELECT doc_id AS key, length FROM lens), {batched('keyed')} SELECT * EXCLUDE (key), key AS doc_id FROM batched"


def filled(x: str, filler: int) -> str:
    return f"list_concat({x}, list_transform(range(width - len(ids)), lambda v: {filler}))"


WIDE = """wide AS (SELECT *, (ceil(max(len(ids)) OVER (PARTITION BY bucket, part, batch) / 8) * 8)::INTEGER AS width FROM batched)"""


def padded(codes: str, source: str, names: str, labels: str, key: str = "key::VARCHAR") -> str:
    return f"""WITH {codes}, {batched(source, key=key)}, {WIDE}
SELECT {names}, bucket, part, batch, width, {csv(filled('ids', 0))} AS ids,
       {csv(filled(ones('ids'), 0))} AS mask, {csv(filled(labels, -100))} AS labels FROM wide"""


def efficiency(name: str, label: str) -> str:
    return f"""SELECT '{label}' AS arrangement, count(*) AS n_batches, sum(real_n)::BIGINT AS real_tokens,
sum(pad_n)::BIGINT AS padded_tokens, round(sum(real_n) / sum(pad_n), 4) AS efficiency
FROM (SELECT sum(len(ids)) AS real_n, ceil(max(len(ids)) / 8) * 8 * count(*) AS pad_n
      FROM {name} GROUP BY bucket, part, batch)"""


EFFICIENCY = f"""WITH {DOC_CODES}, {batched('coded', name='g')},
{batched('coded', bucket='0', order='md5(key::VARCHAR), key', name='m')}
{efficiency('g', 'grouped')} UNION ALL {efficiency('m', 'mixed')}"""
FLAGSHIP = f"""WITH {DOCS}, {cleaned('raw', 'c', 'math')},
kept AS (SELECT doc_id, t FROM c WHERE {strip('t')} <> ''),
{cap('kept')},
{vocabulary('kept', 't')}, {encoded('kept', 'doc_id')},
{batched('coded')}, {WIDE}
SELECT bucket, part, batch, width, count(*)::INTEGER AS n_rows,
  {csv(f"flatten(list({filled('ids', 0)} ORDER BY slot))")} AS input_ids,
  {csv(f"flatten(list({filled(ones('ids'), 0)} ORDER BY slot))")} AS attention_mask,
  {csv(f"flatten(list({filled('ids', -100)} ORDER BY slot))")} AS labels
FROM wide GROUP BY bucket, part, batch, width"""

# --- run plan -----------------------------------------------------------------

RUN_PLAN = """
WITH counts AS (
  SELECT 'lang' AS kind, lang AS dataset, count(*) AS n_rows FROM documents GROUP BY lang
  UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source
  UNION ALL SELECT 'returnflag', l_returnflag, count(*) FROM lineitem GROUP BY l_returnflag
  UNION ALL SELECT 'linestatus', l_linestatus, count(*) FROM lineitem GROUP BY l_linestatus),
a AS (SELECT *, n_rows // 8 AS steps_per_epoch, n_rows // 8 * 2 AS total_steps, 2::BIGINT AS epochs FROM counts),
b AS (SELECT *, CASE WHEN greatest(steps_per_epoch, 1) < 4000 THEN 0.22::DOUBLE ELSE 0.18::DOUBLE END AS floor_fraction,
  round(0.95::DOUBLE - 0.30::DOUBLE * greatest(least((log10(greatest(total_steps, 10)) - 1) / 4, 1.0), 0.0), 4) AS hard_cap_fraction
  FROM a),
c AS (SELECT *, greatest(floor(greatest(steps_per_epoch, 1) * floor_fraction)::BIGINT, 50) AS min_stop_step,
  floor(total_steps * hard_cap_fraction)::BIGINT AS hard_cap_step,
  greatest(75, floor(total_steps * 0.01::DOUBLE)::BIGINT) AS warmup_steps, n_rows * 2 AS exposure FROM b)
SELECT * EXCLUDE (exposure), CASE
  WHEN exposure < 1500 THEN 'linear' WHEN min_stop_step / exposure >= 0.36 THEN 'linear'
  WHEN exposure BETWEEN 1500 AND 40000 AND min_stop_step / exposure <= 0.18 AND exposure / 3 < min_stop_step
  THEN 'cosine_with_restarts' ELSE 'cosine' END AS schedule FROM c"""
WINDOWS = """
WITH s AS (SELECT l_returnflag AS run_name, count(*) AS steps_total FROM lineitem GROUP BY l_returnflag),
w AS (SELECT *, greatest(128, greatest(96, floor(steps_total * 0.015::DOUBLE)::BIGINT)) AS window FROM s)
SELECT run_name, steps_total, "window", greatest(48, floor("window" * 0.75)::BIGINT) AS slope_window,
       greatest(24, "window" // 3) AS history FROM w"""

# --- metrics and monitor ------------------------------------------------------

LOSSES = """
vecs AS (SELECT vec_id, embedding::DOUBLE[] AS x, label FROM embeddings),
losses AS (SELECT vec_id, label, ln(list_sum(list_transform(x, lambda v: exp(v - list_max(x))))) + list_max(x) AS lse, x FROM vecs)"""
PERPLEXITY = f"""
WITH {LOSSES}, each AS (SELECT label::VARCHAR AS label, lse - x[label + 1] AS loss FROM losses),
m AS (SELECT label, count(*) AS n_positions, avg(loss) AS l FROM each GROUP BY label
      UNION ALL SELECT 'all', count(*), avg(loss) FROM each)
SELECT label, n_positions, {steady('l')} AS eval_loss, {steady('exp(l)')} AS perplexity FROM m"""
TRAINER_ORDER = f"""WITH {LENGTHS},
numbered AS (SELECT doc_id, length, row_number() OVER (ORDER BY md5('{q.SEED}:' || doc_id), doc_id) AS n,
  greatest(1, least(count(*) OVER () // ({q.BATCH} * 4), 50)) * {q.BATCH} AS size FROM lens),
placed AS (SELECT *, (n - 1) // size * size + row_number() OVER (PARTITION BY (n - 1) // size ORDER BY length DESC, n) - 1 AS spot
  FROM numbered),
longest AS (SELECT spot AS top FROM placed WHERE spot % size = 0 ORDER BY length DESC, spot LIMIT 1),
moved AS (SELECT doc_id, length, CASE WHEN spot = top THEN 0 WHEN spot = 0 THEN top ELSE spot END AS place FROM placed, longest)
SELECT doc_id, length, place AS position, place // {q.BATCH} AS batch FROM moved"""
IMAGE_STATES = """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'bmp' WHEN 1 THEN 'gif' ELSE 'webp' END AS format, doc_id % 5 > 1 AS sound
FROM documents"""
PERPLEXITY_SHIFTED = f"""
WITH {LOSSES}, nxt AS (SELECT vec_id // 16 AS sequence, lse, x,
  lead(label) OVER (PARTITION BY vec_id // 16 ORDER BY vec_id) AS target FROM losses),
m AS (SELECT sequence, count(*) AS n_positions, avg(lse - x[target + 1]) AS l FROM nxt
      WHERE target IS NOT NULL AND target <> -100 GROUP BY sequence)
SELECT sequence, n_positions, {steady('l')} AS eval_loss, {steady('exp(l)')} AS perplexity FROM m"""
EVENT_LOG = """
log AS (SELECT *, n AS step FROM (SELECT user_id AS run_id, value AS loss,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events))"""
HOURLY_LOG = """
hours AS (SELECT user_id AS run_id, event_id, value AS loss,
  floor((epoch_us(ts) // 1000000 - epoch(TIMESTAMP '2024-01-01')) / 3600)::BIGINT AS step FROM events WHERE event_type <> 'error'),
log AS (SELECT run_id, step, arg_min(loss, event_id) AS loss,
        row_number() OVER (PARTITION BY run_id ORDER BY step) AS n FROM hours GROUP BY run_id, step)"""


def series(scale: float = 1.0, s=q.TREND, log: str = EVENT_LOG) -> str:
    """CTE ``traced``: smoothed loss, best, spread, slope and gates per record."""
    return f"""{log},
e AS (SELECT * REPLACE (loss / {scale}::DOUBLE AS loss),
      0.001::DOUBLE * least(n / 10.0::DOUBLE, greatest((70 - n) / 60.0::DOUBLE, 0)) AS lr FROM log),
e_at AS (SELECT *, (n - 1) // 1000 AS part, (n - 1) % 1000 AS place FROM e),
e_own AS (SELECT *, sum(CASE WHEN n = 1 THEN loss ELSE (1 - {s.beta}::DOUBLE) * loss END * pow({s.beta}::DOUBLE, -place))
          OVER (PARTITION BY run_id, part ORDER BY n) * pow({s.beta}::DOUBLE, place) AS own FROM e_at),
e_ends AS (SELECT run_id, part + 1 AS part, own AS carried FROM e_own WHERE place = 999),
ema AS (SELECT o.* EXCLUDE (part, place, own), own + coalesce(carried, 0) * pow({s.beta}::DOUBLE, place + 1) AS ema
        FROM e_own o LEFT JOIN e_ends USING (run_id, part)),
f AS (SELECT *, min(ema) OVER (PARTITION BY run_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low,
  greatest(CASE WHEN least(n, {s.window}) < 3 THEN 0 ELSE 1.4826 * mad(ema) OVER w END, {s.sigma_floor}) AS sigma,
  CASE WHEN least(n, {s.slope_window}) < 8 THEN 0 ELSE regr_slope(ema, n) OVER v END AS slope,
  step >= {s.warmup} AS warm, step / {s.steps_total}::DOUBLE >= {s.exposure_floor}::DOUBLE AS exposed,
  n >= {s.history} AS enough
  FROM ema WINDOW w AS (PARTITION BY run_id ORDER BY n ROWS BETWEEN ({s.window} - 1) PRECEDING AND CURRENT ROW),
                  v AS (PARTITION BY run_id ORDER BY n ROWS BETWEEN ({s.slope_window} - 1) PRECEDING AND CURRENT ROW)),
g AS (SELECT *, low IS NULL OR ema < low - 1e-12 AS fresh FROM f),
h AS (SELECT *, min(ema) OVER u AS best_ema, n - max(CASE WHEN fresh THEN n END) OVER u AS since_best,
  lr <= max(CASE WHEN warm AND exposed THEN lr END) OVER u * {s.lr_fraction}::DOUBLE + 1e-12 AS lr_known FROM g
  WINDOW u AS (PARTITION BY run_id ORDER BY n)),
traced AS (SELECT *, coalesce(lr_known, lr <= 1e-12) AS lr_ok, slope >= {s.slope_threshold} AS worsening,
  since_best >= {s.patience} AND abs(slope) <= {s.slope_threshold} AND sigma <= {max(0.5 * s.sigma_floor, 0.05)} AS plateau FROM h)"""


DEDUP = f"WITH {HOURLY_LOG} SELECT run_id, step, n, loss FROM log"
DEDUP_EMA = f"WITH {series(log=HOURLY_LOG)} SELECT run_id, step, n, {steady('ema')} AS ema FROM traced"
EMA_SERIES = f"WITH {series()} SELECT run_id, n, {steady('ema')} AS ema FROM traced"
EMA_FINAL = """
WITH logs AS (SELECT user_id AS run_id, list(value ORDER BY ts, event_id) AS xs FROM events GROUP BY user_id)
SELECT run_id, len(xs) AS n, {} AS ema FROM logs""".format(
    steady("list_reduce(xs, lambda a, x: 0.9::DOUBLE * a + (1 - 0.9::DOUBLE) * x)")
)
SINCE_BEST = f"""WITH {series()} SELECT run_id, n, {steady('best_ema')} AS best_ema, since_best,
greatest({q.TREND.cooldown} - since_best, 0) AS cooldown FROM traced"""
SIGMA = f"WITH {series()} SELECT run_id, n, {steady('sigma')} AS sigma FROM traced"
SLOPE = f"WITH {series()} SELECT run_id, n, {steady('slope')} AS slope FROM traced"
GATES = f"WITH {series()} SELECT run_id, n, warm, exposed, lr_ok, enough FROM traced"
CALM = series(q.CALM_SCALE, q.CALM)
PLATEAU = f"WITH {CALM} SELECT run_id, n, since_best, plateau, worsening FROM traced"
TRACE = f"""WITH {CALM} SELECT run_id, n AS step, {steady('ema', 6)} AS ema, {steady('best_ema', 6)} AS best_ema,
{steady('sigma', 6)} AS sigma, {steady('slope', 6)} AS slope, since_best, plateau, worsening
FROM traced WHERE warm AND exposed AND enough AND n % 5 = 0"""


def decisions(scale: float, s, log: str = EVENT_LOG, cap: str | None = None) -> str:
    if cap is None:
        cap = 10 ** 9 if s.hard_cap_step is None else s.hard_cap_step
    passed = "r.warm AND r.exposed AND r.enough"
    improved = f"(w.ref - r.ema >= {s.min_drop} OR (w.ref - r.ema) / (r.sigma + 1e-12) >= {s.min_sigmas})"
    return f"""WITH RECURSIVE {series(scale, s, log)},
records AS MATERIALIZED (SELECT * FROM traced WHERE step < {cap}),
walk AS (
  SELECT run_id, n, step, ema AS ref, false AS stopped FROM records WHERE n = 1
  UNION ALL
  SELECT r.run_id, r.n, r.step, CASE WHEN NOT ({passed}) OR {improved} THEN r.ema ELSE w.ref END,
         {passed} AND NOT {improved} AND (r.plateau OR r.worsening)
  FROM walk w JOIN records r ON r.run_id = w.run_id AND r.n = w.n + 1 WHERE NOT w.stopped),
stops AS (
  SELECT run_id, step AS stop_step, 'trend' AS reason FROM walk WHERE stopped
  UNION ALL SELECT run_id, min(step), 'hard_cap' FROM every_step WHERE step >= {cap} GROUP BY run_id)
SELECT run_id, min(stop_step) AS stop_step, arg_min(reason, stop_step) AS reason FROM stops GROUP BY run_id"""


EVERY_STEP = ", every_step AS (SELECT * FROM log)"
# The hard cap also counts steps whose records have no loss.
EVERY_HOUR = """, every_step AS (SELECT user_id AS run_id,
  floor((epoch_us(ts) // 1000000 - epoch(TIMESTAMP '2024-01-01')) / 3600)::BIGINT AS step FROM events)"""
PLAN_COLUMNS = SimpleNamespace(
    **{**vars(q.monitor.MonitorSettings()), "steps_total": "steps_total", "warmup": "warmup", "window": "window_rows",
       "slope_window": "slope_rows", "history": "history"})
PLANNED_LOG = """
numbered AS (SELECT ascii(event_type)::BIGINT AS run_id, value AS loss,
  row_number() OVER (PARTITION BY ascii(event_type) ORDER BY ts, event_id) AS n FROM events),
sizes AS (SELECT run_id, count(*) AS steps_total FROM numbered GROUP BY run_id),
planned AS (SELECT *, greatest(75, floor(steps_total * 0.01::DOUBLE)::BIGINT) AS warmup,
  floor(steps_total * round(0.95::DOUBLE - 0.30::DOUBLE * greatest(least((log10(greatest(steps_total, 10)) - 1) / 4, 1.0), 0.0), 4))::BIGINT AS cap,
  greatest(128, greatest(96, floor(steps_total * 0.015::DOUBLE)::BIGINT)) AS window_rows FROM sizes),
log AS (SELECT n.*, n AS step, steps_total, warmup, cap, window_rows,
  greatest(48, floor(window_rows * 0.75)::BIGINT) AS slope_rows, greatest(24, window_rows // 3) AS history
  FROM numbered n JOIN planned USING (run_id))"""


HARD_CAP = f"""
SELECT run_id, step AS stop_step, 'hard_cap' AS reason
FROM (SELECT user_id AS run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events)
WHERE step = {q.TREND.hard_cap_step}"""

ORACLES = {
    "sft_pairs": SFT_PAIRS,
    "sft_prompt": SFT_PROMPT,
    "nonempty_filter": NONEMPTY,
    "clean_math": clean_documents("math"),
    "clean_latex": clean_documents("latex"),
    "clean_code": clean_documents("code"),
    "clean_other": clean_documents("other"),
    "clean_pages": CLEAN_PAGES,
    "strip_tags_pages": STRIP_TAGS,
    "denylist_hits": DENYLIST_HITS,
    "catalog_detect_mode": DETECT,
    "catalog_role_map": ROLE_MAP,
    "ledger_new_sources": LEDGER,
    "seeded_shuffle_key": SHUFFLE,
    "prompt_preview": PREVIEW,
    "chat_render": CHAT,
    "causal_text": clean_documents("math") + f" WHERE {strip('t')} <> ''",
    "instruction_template": INSTRUCTION,
    "multimodal_text": MULTIMODAL,
    "vision_prompt": VISION,
    "retention_report": RETENTION,
    "token_length": TOKEN_LENGTH,
    "length_percentiles": PERCENTILES,
    "auto_max_length": AUTO_LENGTH,
    "vocab_topk": VOCAB,
    "tokenize_truncate": TOKENIZE,
    "causal_labels": LABELS,
    "answer_only_labels": ANSWER_ONLY,
    "nonempty_ids": NONEMPTY_IDS,
    "tokenized_export": EXPORT,
    "export_resumed": EXPORT,
    "length_grouped_batches": GROUPED,
    "padded_batches": padded(DOC_CODES, "coded", "key AS doc_id", "ids"),
    "padded_answer_only": padded(
        PAIR_CODES, "answered", "key.conv_id AS conv_id, key.turn AS turn", "labels", "key.conv_id || ':' || key.turn"),
    "padding_efficiency": EFFICIENCY,
    "flagship_batches": FLAGSHIP,
    "run_plan": RUN_PLAN,
    "run_plan_footers": f"SELECT * FROM ({RUN_PLAN}) WHERE kind IN ('lang', 'source')",
    "monitor_windows": WINDOWS,
    "perplexity": PERPLEXITY,
    "perplexity_shifted": PERPLEXITY_SHIFTED,
    "perplexity_chunked": PERPLEXITY,
    "trainer_order": TRAINER_ORDER,
    "image_states": IMAGE_STATES,
    "dedup_steps": DEDUP,
    "dedup_ema": DEDUP_EMA,
    "dedup_stop": decisions(1.0, q.TREND, HOURLY_LOG + EVERY_HOUR),
    "ema_final": EMA_FINAL,
    "ema_series": EMA_SERIES,
    "since_best": SINCE_BEST,
    "mad_sigma": SIGMA,
    "ema_slope": SLOPE,
    "gate_flags": GATES,
    "plateau_worsening": PLATEAU,
    "monitor_trace": TRACE,
    "stop_decision": decisions(1.0, q.TREND, EVENT_LOG + EVERY_STEP),
    "stop_decision_calm": decisions(q.CALM_SCALE, q.CALM, EVENT_LOG + EVERY_STEP),
    "stop_decision_planned": decisions(q.PLANNED_SCALE, PLAN_COLUMNS, PLANNED_LOG + EVERY_STEP, "cap"),
    "hard_cap_stop": HARD_CAP,
    "stream_convergence": decisions(1.0, q.TREND, EVENT_LOG + EVERY_STEP),
    "stream_convergence_planned": decisions(q.PLANNED_SCALE, PLAN_COLUMNS, PLANNED_LOG + EVERY_STEP, "cap"),
    "stream_out_of_order": decisions(1.0, q.TREND, EVENT_LOG + EVERY_STEP),
}
