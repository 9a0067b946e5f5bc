"""Packing token pieces into sequences by non-negative least squares over a length histogram.

Documents are cut into windows of ``width`` tokens and a rest.  The pieces are
counted by length.  Shallow combinations of length classes that fill a window
exactly are enumerated, the number of times each is used is solved against the
histogram by least squares with counts that can't be negative, and rounded
down.  A class stands for a few lengths; its longest pieces serve first, and
from then on only exact lengths count.  What remains of the histogram is packed
greedily, best fit first, also into the room that the combinations leave.

The histogram has at most ``width`` entries and the plan's size follows it, so
the driver's work does not depend on the number of documents.  A piece finds
its place from its length and its rank among those of that length: ranks come
from the counts per task, added up in order.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import read_columns, ready, record
from corpusloom.session import stage_table

SEQUENCE = 2048
CLASS_WIDTH = 8
DEPTH = 3
END_ID = 1
CACHE_WORDS = 400_000
LAST_LATIN = 0xC8  # the highest first byte of Latin letters that stand for themselves in every normal form

Plan = list[tuple[tuple[int, ...], int]]


def shallow_combinations(classes: np.ndarray, total: int, depth: int) -> list[tuple[int, ...]]:
    """Falling tuples of at most ``depth`` of the ``classes`` that add up to ``total``."""
    known, found = set(classes.tolist()), []

    def extend(taken: tuple[int, ...], rest: int) -> None:
        if rest == 0:
            found.append(taken)
        elif len(taken) == depth - 1:
            if rest in known and rest <= (taken[-1] if taken else rest):
                found.append((*taken, rest))
        else:
            top = min(rest, taken[-1] if taken else rest)
            for c in classes:
                if c <= top and c * (depth - len(taken)) >= rest:  # the largest comes first
                    extend((*taken, int(c)), rest - int(c))
    extend((), total)
    return sorted(set(found), reverse=True)


def non_negative_counts(members: np.ndarray, histogram: np.ndarray, rounds: int = 600) -> np.ndarray:
    """``x >= 0`` that brings the use of classes near the histogram in least squares.

    ``members[s]`` holds the positions of strategy ``s`` in the histogram, the
    last position standing for no class.  Accelerated projected gradient; the
    weights let a missing short piece count less than a missing long one.
    """
    size = len(histogram) - 1
    target, x = histogram.astype(float), np.zeros(len(members))
    weights = np.append(np.linspace(0.2, 1.0, size), 0.0)

    def used(v: np.ndarray) -> np.ndarray:
        return sum(np.bincount(members[:, d], v, size + 1) for d in range(members.shape[1]))

    def back(r: np.ndarray) -> np.ndarray:
        return r[members].sum(axis=1)
    probe = np.ones(len(members))
    for _ in range(30):  # the largest curvature, by power iteration
        probe = back(weights * used(probe))
        length = np.linalg.norm(probe)
        probe /= length
    step, ahead, pace = 1 / (1.05 * length), x, 1.0
    for _ in range(rounds):
        moved = np.maximum(ahead - step * back(weights * (used(ahead) - target)), 0)
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, x, pace = moved + (pace - 1) / faster * (moved - x), moved, faster
    return x


def least_squares_plan(counts: np.ndarray, total: int, depth: int = DEPTH) -> tuple[Plan, np.ndarray]:
    """Combinations with whole repeat counts, and the histogram that they leave.

    ``counts[c]`` is the number of pieces of class ``c``, of ``total`` units at most.
    """
    classes = np.flatnonzero(counts)
    combos = shallow_combinations(classes, total, depth) if len(classes) else []
    rest, plan = counts.astype(np.int64).copy(), []
    if not combos:
        return plan, rest
    at = {int(c): i for i, c in enumerate(classes)}
    members = np.full((len(combos), depth), len(classes))
    for s, combo in enumerate(combos):
        members[s, : len(combo)] = [at[c] for c in combo]
    x = np.floor(non_negative_counts(members, np.append(counts[classes], 0)) + 1e-6).astype(np.int64)
    for s in np.argsort(-x, kind="stable"):  # rounding can overdraw a class by a little; never by more than there is
        need = np.bincount(np.array(combos[s]), minlength=len(rest))
        used = np.flatnonzero(need)
        times = int(min(x[s], (rest[used] // need[used]).min()))
        if times > 0:
            rest[used] -= times * need[used]
            plan.append((combos[s], times))
    return plan, rest


def exact_plan(plan: Plan, counts: np.ndarray, class_width: int) -> tuple[Plan, np.ndarray]:
    """The plan of classes in lengths, and the lengths that it leaves; each class gives its longest pieces first."""
    rest = counts.copy()

    def longest(c: int) -> int:
        """The greatest length that a class still has."""
        lengths = range(min(c * class_width, len(rest) - 1), (c - 1) * class_width, -1)
        return next(length for length in lengths if rest[length])
    made: Plan = []
    for combo, times in plan:
        while times:
            need: dict[int, int] = {}
            for c in combo:
                own = longest(c)
                if need.get(own, 0) >= rest[own]:  # the last of this length is taken by this sequence already
                    rest[own] -= need[own]
                    other = longest(c)
                    rest[own] += need[own]
                    own = other
                need[own] = need.get(own, 0) + 1
            taken = min(times, *[int(rest[length]) // n for length, n in need.items()])
            for length, n in need.items():
                rest[length] -= n * taken
            made.append((tuple(length for length, n in need.items() for _ in range(n)), taken))
            times -= taken
    return made, rest


def greedy_plan(counts: np.ndarray, total: int, begun: Plan = ()) -> Plan:
    """Best fit, longest first, over whole groups of equal sequences at a time; ``begun`` sequences are filled up."""
    open_: defaultdict[int, list[list]] = defaultdict(list)  # room left -> [combination, times]
    for combo, times in begun:
        open_[total - sum(combo)].append([combo, times])
    rooms = sorted(open_)

    def put(room: int, combo: tuple[int, ...], times: int) -> None:
        if not open_[room]:
            insort(rooms, room)
        open_[room].append([combo, times])
    for c in range(len(counts) - 1, 0, -1):
        left = int(counts[c])
        while left:
            at = bisect_left(rooms, c)
            if at < len(rooms):
                room = rooms[at]
                combo, times = open_[room].pop()
                if not open_[room]:
                    del rooms[at]
                each = min(room // c, left)      # as many of this length as one sequence takes
                taken = min(times, left // each)
                if taken < times:
                    put(room, combo, times - taken)
                put(room - each * c, (*combo, *(c,) * each), taken)
                left -= taken * each
            else:
                each = min(total // c, left)
                times = left // each
                put(total - each * c, (c,) * each, times)
                left -= times * each
    return [(tuple(sorted(combo, reverse=True)), times) for groups in open_.values() for combo, times in groups]


def packing_plan(counts: np.ndarray, total: int, depth: int = DEPTH, class_width: int = 1) -> Plan:
    """How often each combination of lengths is used; ``counts[n]`` pieces have ``n`` of ``total`` units."""
    lengths = np.arange(len(counts))
    classes = np.bincount(-(-lengths // class_width), counts, total // class_width + 1).astype(np.int64)
    plan, _ = least_squares_plan(classes, total // class_width, depth)
    exact, rest = exact_plan(plan, counts.astype(np.int64), class_width)
    return greedy_plan(rest, total, exact)


class Slots:
    """For each class, runs of ranks and the sequences they go to."""

    def __init__(self, plan: Plan, n_classes: int):
        runs: list[list[tuple[int, int, int, int]]] = [[] for _ in range(n_classes)]
        filled, sequence = [0] * n_classes, 0
        for combo, times in plan:
            for c in set(combo):
                each = combo.count(c)
                runs[c].append((filled[c], sequence, each, combo.index(c)))
                filled[c] += each * times
            sequence += times
        self.runs = [np.array(r, dtype=np.int64).reshape(-1, 4) for r in runs]

    def place(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and slot of each piece."""
        sequence, slot = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
        for c in np.unique(classes):
            own = np.flatnonzero(classes == c)
            run = self.runs[c][np.searchsorted(self.runs[c][:, 0], ranks[own], "right") - 1]
            local = ranks[own] - run[:, 0]
            sequence[own] = run[:, 1] + local // run[:, 2]
            slot[own] = run[:, 3] + local % run[:, 2]
        return sequence, slot


def is_latin_word(word: str) -> bool:
    """Whether a word is Latin letters only, none of which turns into two when lowered."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0240" and "\u0130" not in word))


class _Numbered(dict):
    """Words by number; a new word gets the next one and is noted as fresh."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


def plain_form(text: str) -> str:
    """A text with the same ids and fewer different words.

    The vocabulary lowers letters and cuts words from the marks behind them.
    Where all characters are Latin, both can be done beforehand: letters are
    lowered, and a full stop or comma between a letter or digit and a blank is
    set apart.
    """
    if not text or "\u0130" in text:  # the one Latin letter that becomes two when lowered
        return text
    data = np.frombuffer(text.encode(), np.uint8)
    if data.max() > LAST_LATIN:
        return text
    data = np.frombuffer(text.lower().encode() + b" ", np.uint8)
    at = np.flatnonzero((data == 44) | (data == 46))
    at = at[(at > 1) & np.isin(data[np.minimum(at + 1, len(data) - 1)], (32, 10))]
    before, lead = data[at - 1], data[at - 2]
    ascii_ = ((before >= 97) & (before <= 122)) | ((before >= 48) & (before <= 57))
    # Two-byte characters from C3 80 on are letters but for the signs of multiplication and division.
    latin = (before >= 0x80) & (lead >= 0xC3) & ~((lead == 0xC3) & ((before == 0x97) | (before == 0xB7)))
    return np.insert(data[:-1], at[ascii_ | latin], 32).tobytes().decode()


class WordCoder:
    """Token ids of texts through the tokenizer, each different word once.

    The vocabulary's rules never look across white space, so a word has the
    same ids wherever it stands.  At most ``CACHE_WORDS`` words are remembered
    from one batch to the next.
    """

    END = " "  # no word has a blank

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        ids = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(ids.values()) + 1, dtype=bool)  # ids that end a piece
        self.closes[[i for token, i in ids.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = _Numbered()
        self.flat, self.begins = array("I", [END_ID]), array("q", [0, 1])
        self.known[self.END] = 0

    def _learn(self) -> None:
        """Append the ids of the fresh words."""
        fresh, self.known.fresh = self.known.fresh, []
        for at in range(0, len(fresh), 5_000):
            for raw in self._coded(fresh[at: at + 5_000]):
                self.flat.frombytes(raw)
                self.begins.append(len(self.flat))

    def _coded(self, words: list[str]) -> list[bytes]:
        """Ids of each word.  Words of Latin letters are one piece each, told by its closing id, and coded in one call."""
        plain = [is_latin_word(w) for w in words]
        ids = np.array(self._ids([" ".join(compress(words, plain))])[0], dtype="<u4")
        ends = ((np.flatnonzero(self.closes[ids]) + 1) * 4).tolist()
        if len(ends) != sum(plain):  # another vocabulary may cut them otherwise
            return [np.array(x, dtype="<u4").tobytes() for x in self._ids(words)]
        raw = ids.tobytes()
        cut = iter([raw[a:b] for a, b in zip([0, *ends[:-1]], ends)])
        others = iter(self._ids([w for w, p in zip(words, plain) if not p]))
        return [next(cut) if p else np.array(next(others), dtype="<u4").tobytes() for p in plain]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the closing id, as little-endian unsigned 32-bit numbers."""
        words: list[str] = []
        for text in texts:
            words += plain_form(text).replace("\n", " ").split(" ")
            words.append(self.END)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self._learn()
        flat, begins = np.array(self.flat, dtype="<u4"), np.array(self.begins)
        sizes = begins[at + 1] - begins[at]
        ends = np.cumsum(sizes)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[at] - ends + sizes, sizes)]
        if len(self.known) > CACHE_WORDS:
            self.forget()
        return np.split(ids, ends[at == 0][:-1]) if texts else []


def cut_rows(docs: DataFrame, vocabulary: str, width: int, key: str, text: str) -> DataFrame:
    """The pieces of every document with their number within task and length."""
    rows = read_columns(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    ready(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        coder, seen = WordCoder(shared.value), np.zeros(width + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pieces(part, coder, seen, task)
        pa.default_memory_pool().release_unused()

    def pieces(batch, coder, seen, task) -> pa.RecordBatch:
        owner, start, length, crc, total = [], [], [], [], []
        for row, ids in enumerate(coder.encode([t or "" for t in batch.column(1).to_pylist()])):
            for s in range(0, len(ids), width):
                owner.append(row)
                start.append(s)
                length.append(min(width, len(ids) - s))
                crc.append(zlib.crc32(ids[s: s + width].tobytes()))
                total.append(len(ids))
        lengths = np.array(length, dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        opens = np.searchsorted(lengths[order], lengths[order], "left")
        number = np.empty(len(lengths), dtype=np.int64)
        number[order] = np.arange(len(lengths)) - opens
        number += seen[lengths]
        seen += np.bincount(lengths, minlength=len(seen))
        return record(
            doc_id=batch.column(0).take(pa.array(owner, pa.int64())), start=pa.array(start, pa.int64()),
            length=lengths, ids_crc32=pa.array(crc, pa.int64()), doc_tokens=pa.array(total, pa.int64()),
            task=np.full(len(lengths), task, dtype=np.int64), number=number)
    return rows.mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task bigint, number bigint")


def pack_documents(
    docs: DataFrame, vocabulary: str, width: int = SEQUENCE, class_width: int = CLASS_WIDTH, depth: int = DEPTH,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``vocabulary`` is the content of a tokenizer file.  Every document ends
    with ``END_ID``, so null and empty texts are one piece of one token.  Rows
    that repeat or share a key are packed each on its own; a null key stays
    null.  Pieces in a sequence follow each other without a gap.
    """
    if width % class_width:
        raise ValueError("class_width must divide width")
    pieces = stage_table(cut_rows(docs, vocabulary, width, key, text), "pieces")
    counted = stage_table(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "counts")
    totals = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()  # ``width`` rows at most
    histogram = np.zeros(width + 1, dtype=np.int64)
    for row in totals:
        histogram[row["length"]] = row["n"]
    slots = Slots(packing_plan(histogram, width, depth, class_width), len(histogram))

    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counted.select("length", "task", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    ranked = pieces.join(begins, ["length", "task"]).withColumn("rank", F.col("before") + F.col("number"))
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, slot = slots.place(batch.column(2).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(slot)],
                [*batch.schema.names[:5], "sequence_id", "slot"])
    kind = pieces.schema["doc_id"].dataType.simpleString()
    placed = ranked.mapInArrow(
        place, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
               "sequence_id bigint, slot bigint")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("slot")
