"""Repeated passages, found by a suffix sort whose comparisons read prefix hashes.

A window of ``span`` bytes is repeated when the same bytes start anywhere else
in the corpus.  To bring equal windows together, each window is filed under
its minimizer, the seed of ``SEED_BYTES`` bytes with the smallest hash in it,
which equal windows share at the same place.  Neighbouring windows mostly
share their minimizer, so a record holds a run of windows.

* A minimizer that occurs once has no repeated window.
* Records with equal bytes repeat each other entirely; they are counted, and
  one of them stands for all.
* The remaining runs are compared by suffix sort: for an offset, the suffixes
  of all runs of a minimizer are merge-sorted.  A comparison finds the common
  extension by binary search over prefix polynomial hashes and then looks at
  one byte; extensions that decide about a removal are verified byte by byte.
  The end of a suffix's longest match never falls when the offset grows, so
  offsets are bisected and only those where the end changes are sorted.
* A minimizer with more than ``hot_runs`` different runs is cut into blocks,
  and the blocks are sorted apart.  What a block can't know is whether a window
  stands in another block: each block puts its windows, every different one
  once, under 128-bit digests, which are counted with partial sums.

Windows can be measured in words as well: every word then becomes a code of
eight bytes, the same steps run over the codes, and only windows and seeds that
begin at a code (``step`` bytes apart) are looked at.  Codes are hashes, so a word is told apart from another with
64 bits; white space between words makes no difference.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE, fresh, map_rows, read_columns, ready, record, sorted_groups, texts_as_bytes
from corpusloom.session import scratch_folder, stage_table

SPAN = 400
SEED_BYTES = 100
HOT_RUNS = 4096
SORT_ROWS = 4000                      # runs that are sorted together, if their groups allow
BASE = 0x9E3779B97F4A7C15 | 1
POSITION_BITS = 22                    # places of a minimizer inside a part
PART_BYTES = (1 << POSITION_BITS) - SPAN
CODE_BYTES = 8                        # of a word, where windows are measured in words
BYTES, WORDS = "bytes", "words"
STEPS = {BYTES: 1, WORDS: CODE_BYTES}  # from one window start to the next

RUNS = "minimizer bigint, doc_id {}, text_hash bigint, first bigint, last bigint, at bigint, high bigint, low bigint"
PIECES = (
    "minimizer bigint, block bigint, doc_id {}, text_hash bigint, first bigint, last bigint, at bigint, "
    "copies bigint, hot boolean, bytes binary")
RANGES = "doc_id {}, text_hash bigint, first bigint, last bigint, window binary, several boolean"

_powers: dict[str, np.ndarray] = {}


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and ``BASE ** -i`` modulo 2**64."""
    if len(_powers.get("up", ())) < length:
        size = max(1 << 16, length + length // 4)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:length], _powers["down"][:length]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``h[i]`` is the polynomial hash of the first ``i`` bytes."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def window_hashes(prefix: np.ndarray, length: int, step: int = 1) -> np.ndarray:
    """Hash of every window of ``length`` bytes, ``step`` bytes apart, alike wherever it stands."""
    _, down = powers(len(prefix))
    begins = slice(0, len(prefix) - length, step)
    return (prefix[length::step] - prefix[begins]) * down[begins]


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` neighbours, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def minimizer_runs(text: bytes, span: int, seed: int, step: int = 1) -> Iterator[tuple[np.ndarray, ...]]:
    """``minimizer, first, last, at``: runs of window starts that share the minimizer at ``at``.

    Windows and seeds start at multiples of ``step``, of which ``span`` and the
    length of the text are multiples too.
    """
    size = PART_BYTES // step * step
    for offset in range(0, max(len(text) - span + 1, 0), size):
        data = np.frombuffer(text[offset: offset + size + span - step], dtype=np.uint8)
        hashes = mixed(window_hashes(prefix_hashes(data), seed, step))
        low = np.uint64(POSITION_BITS)
        keyed = (hashes >> low << low) | np.arange(len(hashes), dtype=np.uint64)  # the leftmost of equals
        place = (sliding_least(keyed, (span - seed) // step + 1) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:] - 1, len(place) - 1)
        at = place[first]
        yield hashes[at].view(np.int64), first * step + offset, last * step + offset, at * step + offset


_gap = np.zeros(256, dtype=bool)
_gap[list(WHITE.encode())] = True
GAP = re.compile(rb"[\x20\x09-\x0D]")


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    inside = np.concatenate([[False], ~_gap[np.frombuffer(text, dtype=np.uint8)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_codes(text: bytes) -> bytes:
    """``CODE_BYTES`` for each word; long texts are cut between words."""
    made, at = [], 0
    while at < len(text):
        gap = GAP.search(text, at + PART_BYTES) if at + PART_BYTES < len(text) else None
        end = gap.start() if gap else len(text)
        part = text[at:end]
        starts, ends = word_spans(part)
        sums = prefix_hashes(np.frombuffer(part, dtype=np.uint8))
        _, down = powers(len(sums))
        hashes = (sums[ends] - sums[starts]) * down[starts] + mixed((ends - starts).astype(np.uint64))
        made.append(mixed(hashes).astype("<u8").tobytes())
        at = end
    return b"".join(made)


def units_of(column: pa.Array, unit: str) -> Iterator[bytes]:
    """The strings in which windows are looked for: the texts, or the codes of their words."""
    for text in texts_as_bytes(column):
        yield word_codes(text) if unit == WORDS else text


def digest(text: bytes, salt: int = 0) -> bytes:
    """A digest of 128 bits."""
    return hashlib.blake2b(text, digest_size=16, salt=salt.to_bytes(8, "little")).digest()


def document_runs(docs: DataFrame, span: int, seed: int, unit: str = BYTES) -> DataFrame:
    """All runs of all texts; ``high`` and ``low`` digest a run's bytes and the place of its minimizer."""
    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts, digests, owner = [], [], []
        for row, text in enumerate(units_of(batch.column(1), unit)):
            for minimizer, first, last, at in minimizer_runs(text, span, seed, STEPS[unit]):
                parts.append((minimizer, first, last, at))
                digests += [digest(text[f: x], a) for f, x, a in zip(
                    first.tolist(), (last + span).tolist(), (at - first).tolist())]
                owner.append(np.full(len(first), row))
            if len(digests) > 50_000:
                yield packed(batch, parts, digests, owner)
                parts, digests, owner = [], [], []
        if digests:
            yield packed(batch, parts, digests, owner)

    def packed(batch, parts, digests, owner) -> pa.RecordBatch:
        minimizer, first, last, at = (np.concatenate(side) for side in zip(*parts))
        rows, both = pa.array(np.concatenate(owner)), np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        return record(minimizer=minimizer, doc_id=batch.column(0).take(rows), text_hash=batch.column(2).take(rows),
                      first=first, last=last, at=at, high=both[:, 0], low=both[:, 1])
    return map_rows(docs, make, RUNS.format(docs.schema["doc_id"].dataType.simpleString()))


class Suffixes:
    """Byte strings side by side with their prefix hashes, compared at given starts."""

    def __init__(self, strings: list[bytes]):
        self.data = np.frombuffer(b"".join(strings) + b"\0", dtype=np.uint8)
        self.ends = np.cumsum([len(s) for s in strings])
        self.prefix = prefix_hashes(self.data[:-1])
        self.down = powers(len(self.prefix))[1]

    def common(self, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Length of the common extension from ``a`` and ``b``, up to ``room``, by binary search."""
        low, high = np.zeros_like(room), room.copy()
        for _ in range(int(room.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.prefix[a + middle] - self.prefix[a]) * self.down[a] == (
                self.prefix[b + middle] - self.prefix[b]) * self.down[b]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def verified(self, a: int, b: int, length: int) -> bool:
        return bool((self.data[a: a + length] == self.data[b: b + length]).all())


def merge_sort(group: np.ndarray, start: np.ndarray, room: np.ndarray, texts: Suffixes) -> np.ndarray:
    """Order of suffixes by group, then by bytes; ``group`` is sorted.

    Runs of 1, 2, 4, … neighbours of a group are merged: each suffix finds its
    rank in the sister run by binary search, all of them in step.
    """
    n = len(group)
    order, opens = np.arange(n), np.searchsorted(group, group, "left")
    closes = np.searchsorted(group, group, "right")
    width, widest = 1, int((closes - opens).max(initial=0))
    place = np.arange(n)
    while width < widest:
        local = place - opens
        run = local // width
        begin = opens + (run ^ 1) * width
        low = np.minimum(begin, closes)
        high = np.minimum(begin + width, closes)
        base, right = low.copy(), (run & 1).astype(bool)
        while True:
            active = np.flatnonzero(low < high)
            if not len(active):
                break
            middle = (low[active] + high[active]) >> 1
            mine, other = order[active], order[middle]
            limit = np.minimum(room[mine], room[other])
            length = texts.common(start[mine], start[other], limit)
            cut = length >= limit
            x, y = texts.data[start[mine] + length], texts.data[start[other] + length]
            # Of equal suffixes, those of the left run come first.
            shorter = np.where(room[other] == room[mine], right[active], room[other] < room[mine])
            before = np.where(cut, shorter, y < x)
            low[active] = np.where(before, middle + 1, low[active])
            high[active] = np.where(before, high[active], middle)
        target = opens + (run & ~1) * width + (local - run * width) + (low - base)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        width *= 2
    return order


def longest_matches(
    group: np.ndarray, start: np.ndarray, room: np.ndarray, span: int, texts: Suffixes
) -> np.ndarray:
    """Length of the longest extension that each suffix shares with another of its group."""
    order = merge_sort(group, start, room, texts)
    best = np.zeros(len(order), dtype=np.int64)
    up, down = order[:-1], order[1:]
    same = group[up] == group[down]
    up, down = up[same], down[same]
    shared = texts.common(start[up], start[down], np.minimum(room[up], room[down]))
    for i in np.flatnonzero(shared >= span):
        if not texts.verified(start[up[i]], start[down[i]], shared[i]):
            shared[i] = 0
    np.maximum.at(best, up, shared)
    np.maximum.at(best, down, shared)
    return best


def repeated_starts(
    group: np.ndarray, first: np.ndarray, last: np.ndarray, settled: np.ndarray, strings: list[bytes], span: int,
    step: int = 1,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, low, high``: window starts, relative to the minimizer, that are repeated within the group.

    ``first`` and ``last`` are a run's starts relative to its minimizer, and
    ``strings[i]`` its bytes from ``first`` to ``last + span``.  Rows that are
    ``settled`` only serve as partners.  With ``end(x)`` for the end of the
    longest match from offset ``x``, a window is repeated when
    ``end(x) >= x + span``; ``end`` never falls, so equal ends at two offsets
    settle all between them, and an end too near settles them as unrepeated.
    Starts lie ``step`` bytes apart; what a range holds between them says nothing.
    """
    texts = Suffixes(strings)
    begin = texts.ends - np.array([len(s) for s in strings])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_groups = int(group[-1]) + 1
    low = np.full(n_groups, np.iinfo(np.int64).max)
    high = np.full(n_groups, np.iinfo(np.int64).min)
    np.minimum.at(low, group, first)
    np.maximum.at(high, group, last)

    def ends_at(offset: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Per row the end of its longest match from its group's offset; -1 before its own first start."""
        at = offset[group]
        here = np.flatnonzero(live[group] & (first <= at) & (at < last + span))
        end = np.full(len(group), -1, dtype=np.int64)
        if len(here):
            local = begin[here] + at[here] - first[here]
            end[here] = at[here] + longest_matches(group[here], local, texts.ends[here] - local, span, texts)
        return end

    def put(rows: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> None:
        lows, highs = np.maximum(lows, first[rows]), np.minimum(highs, last[rows])
        some = lows <= highs
        found.append((rows[some], lows[some], highs[some]))

    live = np.ones(n_groups, dtype=bool)
    tasks = [(low, high, live, ends_at(low, live), ends_at(high, live))]
    while tasks:
        low, high, live, e_low, e_high = tasks.pop()
        x, y = low[group], high[group]
        mine = live[group] & ~settled & (first <= y) & (last >= x) & (e_high >= np.maximum(x, first) + span)
        even = mine & (e_low == e_high)
        rows = np.flatnonzero(even)
        put(rows, x[rows], np.minimum(y[rows], e_high[rows] - span))
        mine &= ~even
        near = mine & (y - x <= step)
        for end, at in ((e_low, x), (e_high, y)):
            rows = np.flatnonzero(near & (end >= at + span))
            put(rows, at[rows], at[rows])
        more = np.zeros(n_groups, dtype=bool)
        more[group[mine & ~near]] = True
        if more.any():
            middle = low + ((high - low) // step >> 1) * step
            e_middle = ends_at(middle, more)
            tasks.append((low, middle, more, e_low, e_middle))
            tasks.append((middle, high, more, e_middle, e_high))
    return tuple(np.concatenate(side) for side in zip(*found))


def cut_pieces(docs: DataFrame, wanted: DataFrame, span: int, hot_runs: int, unit: str = BYTES) -> DataFrame:
    """The bytes of the wanted runs, from the texts they lie in."""
    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_list(
        F.struct("minimizer", "first", "last", "at", "copies", "n_runs")).alias("runs"))
    same = docs["doc_id"].eqNullSafe(lists["doc_id"]) & docs["text_hash"].eqNullSafe(lists["text_hash"])
    joined = docs.join(lists, same).select(docs["doc_id"], docs["text_hash"], "text", "runs")

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, texts, hashes = [], units_of(batch.column(2), unit), batch.column(1).to_pylist()
        for row, (text, runs) in enumerate(zip(texts, batch.column(3).to_pylist())):
            for r in runs:
                blocks = -(-r["n_runs"] // hot_runs)
                block = hash((hashes[row], r["first"])) % blocks if blocks > 1 else 0
                out.append((row, r, block, text[r["first"]: r["last"] + span]))
            if len(out) > 5_000:
                yield packed(batch, out, hot_runs)
                out = []
        if out:
            yield packed(batch, out, hot_runs)

    def packed(batch, out, hot_runs) -> pa.RecordBatch:
        rows = pa.array([o[0] for o in out])
        column = {c: [o[1][c] for o in out] for c in ("minimizer", "first", "last", "at", "copies", "n_runs")}
        return record(
            minimizer=pa.array(column["minimizer"], pa.int64()), block=pa.array([o[2] for o in out], pa.int64()),
            doc_id=batch.column(0).take(rows), text_hash=batch.column(1).take(rows),
            first=column["first"], last=column["last"], at=column["at"], copies=column["copies"],
            hot=[n > hot_runs for n in column["n_runs"]], bytes=pa.array([o[3] for o in out], pa.binary()))
    return map_rows(joined, make, PIECES.format(docs.schema["doc_id"].dataType.simpleString()))


def sorted_ranges(pieces: DataFrame, span: int, step: int = 1) -> DataFrame:
    """Repeated window starts of each piece, by suffix sort of its minimizer's block.

    For a block of a hot minimizer, rows with ``window`` are added: every
    different window of the block once, ``several`` if the block settled it.
    """
    ready(pieces.sparkSession)
    kind = pieces.schema["doc_id"].dataType.simpleString()
    dealt = pieces.repartition("minimizer", "block").sortWithinPartitions("minimizer", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, ("minimizer", "block"), SORT_ROWS):
            yield from solve(table)

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        minimizer, block, first, last, at, copies, hot = (
            table[c].to_numpy() for c in ("minimizer", "block", "first", "last", "at", "copies", "hot"))
        group = np.concatenate([[0], np.cumsum((np.diff(minimizer) != 0) | (np.diff(block) != 0))])
        strings = table["bytes"].to_pylist()
        row, low, high = repeated_starts(group, first - at, last - at, copies > 1, strings, span, step)
        yield out(table, row, low + at[row], high + at[row], None, None)
        if hot.any():
            windows: dict[tuple[int, bytes], tuple[int, int, bool]] = {}  # by block
            repeated = {(r, x) for r, a, b in zip(row, low + at[row], high + at[row]) for x in range(a, b + 1)}
            for r in np.flatnonzero(hot):
                for x in range(first[r], last[r] + 1, step):
                    text = strings[r][x - first[r]: x - first[r] + span]
                    key = (int(group[r]), hashlib.blake2b(text, digest_size=16).digest())
                    windows[key] = (r, x, key in windows or copies[r] > 1 or (r, x) in repeated)
            values = list(windows.values())
            rows, starts = (np.array([v[i] for v in values], dtype=np.int64) for i in (0, 1))
            yield out(table, rows, starts, starts, [w for _, w in windows], [bool(v[2]) for v in values])

    def out(table, row, low, high, window, several) -> pa.RecordBatch:
        take = pa.array(row)
        none = [None] * len(row)
        return record(
            doc_id=table["doc_id"].combine_chunks().take(take),
            text_hash=table["text_hash"].combine_chunks().take(take), first=low, last=high,
            window=pa.array(window or none, pa.binary()), several=pa.array(several or none, pa.bool_()))
    return dealt.mapInArrow(run, RANGES.format(kind))


def repeated_windows(
    docs: DataFrame, span: int = SPAN, seed: int = SEED_BYTES, hot_runs: int = HOT_RUNS, unit: str = BYTES
) -> DataFrame:
    """``doc_id, text_hash, first, last``: starts of windows that stand elsewhere too.

    ``docs`` has ``doc_id, text, text_hash``; ``span`` and ``seed`` are bytes of what ``unit`` makes of a text.
    What is staged on the way is deleted.
    """
    with scratch_folder(docs.sparkSession, "repeats") as folder:
        return stage_table(unstaged_windows(docs, span, seed, hot_runs, unit, folder), "windows")


def unstaged_windows(docs: DataFrame, span: int, seed: int, hot_runs: int, unit: str, folder: str) -> DataFrame:
    """``repeated_windows`` as a plan over tables that are staged in ``folder``."""
    columns = ["doc_id", "text_hash", "first", "last"]
    runs = stage_table(document_runs(docs, span, seed, unit), "runs", folder)
    shared = runs.groupBy("minimizer").agg(
        F.count("*").alias("n"),
        ((F.min("high") == F.max("high")) & (F.min("low") == F.max("low"))).alias("uniform"),
    ).filter("n > 1").select("minimizer", "uniform")
    shared = stage_table(shared, "minimizers", folder)  # so that the join can split a hot minimizer
    found = stage_table(runs.join(shared, "minimizer"), "shared", folder)
    whole = found.filter("uniform").select(*columns)

    mixed = found.filter("NOT uniform")
    classes = stage_table(mixed.groupBy("minimizer", "high", "low").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_hash", "first", "last", "at")).alias("one"),
    ).select("minimizer", "high", "low", "copies", "one.*"), "classes", folder)
    copied = classes.filter("copies > 1").select("minimizer", "high", "low")
    whole = whole.unionByName(mixed.join(copied, ["minimizer", "high", "low"], "left_semi").select(*columns))

    sizes = stage_table(classes.groupBy("minimizer").agg(F.count("*").alias("n_runs")), "sizes", folder)
    wanted = classes.join(sizes, "minimizer")
    pieces = cut_pieces(docs, wanted, span, hot_runs, unit)
    ranges = stage_table(sorted_ranges(pieces, span, STEPS[unit]), "ranges", folder)
    settled = ranges.filter("window IS NULL").select(*columns)
    windows = ranges.filter("window IS NOT NULL")
    several = windows.groupBy("window").agg((F.count("*") > 1).alias("again")).filter("again").select("window")
    across = windows.filter("NOT several").join(several, "window", "left_semi").select(*columns)
    return whole.unionByName(settled).unionByName(across)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open ranges joined where they touch or overlap."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.append(True, starts[1:] > ends[:-1])
    return starts[opens], ends[np.append(opens[1:], True)]


def with_repeats(
    docs: DataFrame, measures: list[tuple[int, str]], seed: int = SEED_BYTES, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """``docs`` and, as last columns, for each span and unit the ranges of window starts that are repeated.

    Spans are bytes of what the unit makes of a text.  A row without repeats has null or empty lists.
    """
    digest = fresh("text_hash", docs.columns)
    hashed = docs.withColumn(digest, F.xxhash64(F.col("text")))
    own = hashed.select("doc_id", "text", F.col(digest).alias("text_hash"))
    found, lists, names = None, [], []
    for i, (span, unit) in enumerate(measures):
        ranges = repeated_windows(own, span, min(seed, span), hot_runs, unit).withColumn("measure", F.lit(i))
        found = ranges if found is None else found.unionByName(ranges)
        names.append(fresh(f"ranges{i}", hashed.columns))
        lists.append(F.collect_list(F.when(F.col("measure") == i, F.struct("first", "last"))).alias(names[-1]))
    lists = found.groupBy("doc_id", "text_hash").agg(*lists)
    same = hashed["doc_id"].eqNullSafe(lists["doc_id"]) & (hashed[digest] == lists["text_hash"])
    return hashed.join(lists, same, "left").select(*[hashed[f"`{c}`"] for c in docs.columns], *names)


def covered(column: pa.Array, span: int, step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``offsets, starts, ends``: what the windows of a batch's ranges cover, in units of ``step`` bytes.

    Row ``i`` has the entries from ``offsets[i]`` to ``offsets[i + 1]``.  All rows are merged at once, each at a
    place of its own.
    """
    n = len(column)
    rows = np.repeat(np.arange(n), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(column)
    first, last = (pc.struct_field(flat, c).to_numpy(zero_copy_only=False) for c in ("first", "last"))
    first, ends = -(-first // step), last // step + span
    whole = ends - first >= span
    rows, first, ends = rows[whole], first[whole], ends[whole]
    if not len(rows):
        return np.zeros(n + 1, np.int64), first, ends
    width = int(ends.max()) + 1
    starts, ends = merged(first + rows * width, ends + rows * width)
    rows = starts // width
    return np.searchsorted(rows, np.arange(n + 1)), starts - rows * width, ends - rows * width


def without(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes outside the ranges, in order."""
    edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def repeats_removed(
    docs: DataFrame, span: int = SPAN, seed: int = SEED_BYTES, hot_runs: int = HOT_RUNS,
    key: str = "doc_id", text: str = "text", words: int = 0,
) -> DataFrame:
    """``doc_id, n_bytes, starts, ends, kept`` for every row: the removed byte ranges and the bytes that stay.

    With ``words`` a further column, ``repeated_words``, counts the words in
    passages of so many words that also start elsewhere, whatever white space
    stands between them.  Such a passage may be shorter or longer than ``span``
    bytes; it is counted, not removed.

    Null texts are empty; texts under ``span`` bytes have no window and stay
    whole.  A row that is repeated, key and text, is a copy of itself, so all
    its windows are repeated.  Keys may be null.  No rows give no rows.
    """
    measures = [(span, BYTES)] + [(words * CODE_BYTES, WORDS)] * bool(words)
    rows = with_repeats(read_columns(docs, key, text), measures, seed, hot_runs)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = texts_as_bytes(batch.column(1))
        offsets, starts, ends = covered(batch.column(2), span)
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(side, pa.int64())) for side in (starts, ends)]
        kept = [without(t, starts[a:b], ends[a:b]) if a < b else t for t, a, b in zip(texts, offsets, offsets[1:])]
        columns = {
            "doc_id": batch.column(0), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "starts": lists[0], "ends": lists[1], "kept": pa.array(kept, pa.binary())}
        if words:
            offsets, starts, ends = covered(batch.column(3), words, CODE_BYTES)
            sums = np.append(0, np.cumsum(ends - starts))[offsets]
            columns["repeated_words"] = pa.array(np.diff(sums), pa.int64())
        return record(**columns)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary"
    return map_rows(rows, make, schema + ", repeated_words bigint" * bool(words))


def texts_without_repeats(
    docs: DataFrame, span: int = SPAN, seed: int = SEED_BYTES, hot_runs: int = HOT_RUNS, unit: str = BYTES
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``.

    With ``unit`` ``bytes`` a passage is a string of ``span`` bytes, and a
    character that is cut into goes whole.  With ``words`` it is ``span`` words
    in a row, whatever white space stands between them; the white space around
    it stays, and ``seed`` are bytes of codes, eight a word.

    ``n_chars``, if there is such a column, is counted anew.  Texts without
    repeats, null ones too, stay as they are.  Other columns stay, whatever
    their names.
    """
    rows = with_repeats(docs, [(span * STEPS[unit], unit)], seed, hot_runs)
    names = docs.columns
    at, counted = names.index("text"), "n_chars" in names

    def cut(text: str, starts: np.ndarray, ends: np.ndarray) -> str:
        data = text.encode()
        if unit == WORDS:
            begins, past = word_spans(data)
            starts, ends = begins[starts], past[ends - 1]
        return without(data, starts, ends).decode(errors="ignore")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip(names, batch.columns))
        offsets, starts, ends = covered(batch.column(len(names)), span, STEPS[unit])
        texts = [cut(t, starts[a:b], ends[a:b]) if a < b else t
                 for t, a, b in zip(batch.column(at).to_pylist(), offsets, offsets[1:])]
        columns["text"] = pa.array(texts, pa.string())
        if counted:
            columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts]).cast(
                batch.column(names.index("n_chars")).type)
        return record(**columns)
    return map_rows(rows, make, docs.schema)
