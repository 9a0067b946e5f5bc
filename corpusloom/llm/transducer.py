"""Counts of a text from one pass of a byte transducer, and its distinct words.

The transducer reads UTF-8 byte by byte: a table gives the class of each byte,
and a table of states and classes gives the next state and what to emit (a
word begins, a word ends, a capital, a symbol, a code point).  The state says
only whether a word is open, and the class of one byte decides it, so numpy
looks up all bytes of a block at once and only the state at its edge is
carried on.  The emitted word spans go into an open hash table, all at once as
well: a span takes a free slot or compares itself byte by byte with the span
that holds the slot, and moves on if they differ.
"""

from __future__ import annotations

import numpy as np

from corpusloom.llm.common import WHITE
from corpusloom.llm.suffix_dedup import mixed, powers, prefix_hashes

BLOCK_BYTES = 1 << 20            # bytes that are looked up at once
SYMBOLS = "#$%&*|"

GAP, OTHER, CAPITAL, SYMBOL, INSIDE = range(5)     # classes of bytes; INSIDE continues a code point
OUT, IN = range(2)                                 # states
BEGINS, ENDS, IS_CAPITAL, IS_SYMBOL, IS_POINT = 1, 2, 4, 8, 16   # what a transition emits


def class_table(symbols: str = SYMBOLS) -> np.ndarray:
    """The class of each byte; ``symbols`` are ASCII characters."""
    table = np.full(256, OTHER, dtype=np.uint8)
    table[[ord(c) for c in WHITE]] = GAP
    table[ord("A"): ord("Z") + 1] = CAPITAL
    table[[ord(c) for c in symbols]] = SYMBOL
    table[0x80:0xC0] = INSIDE
    return table


NEXT = np.array([OUT, IN, IN, IN, IN], dtype=np.uint8)   # alike in both states
EMITS = np.array([
    [IS_POINT, BEGINS | IS_POINT, BEGINS | IS_POINT | IS_CAPITAL, BEGINS | IS_POINT | IS_SYMBOL, BEGINS],
    [ENDS | IS_POINT, IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0],
], dtype=np.uint8)


def transduce(data: np.ndarray, table: np.ndarray, state: int = OUT) -> tuple[np.ndarray, int]:
    """What each byte emits, and the state after the last."""
    classes = table[data]
    after = NEXT[classes]
    before = np.empty_like(after)
    before[:1], before[1:] = state, after[:-1]
    return EMITS[before, classes], int(after[-1]) if len(after) else state


def same_bytes(data: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of equal length hold equal bytes; eight bytes at a time, ``data`` has eight to spare."""
    eights = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    same = np.ones(len(left), dtype=bool)
    at, open_ = 0, np.arange(len(left))
    while len(open_):
        apart = eights[left[open_] + at] ^ eights[right[open_] + at]
        rest = lengths[open_] - at
        short = rest < 8
        apart[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        same[open_] = apart == 0
        open_, at = open_[(apart == 0) & (rest > 8)], at + 8
    return same


def first_of_equals(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which spans hold a slot of the hash table: one for each owner and different word.

    ``data`` has eight bytes to spare behind the last span.
    """
    n = len(starts)
    if not n:
        return np.empty(0, dtype=bool)
    sums = prefix_hashes(data[: int(ends.max())])
    _, down = powers(len(sums))
    lengths = ends - starts
    keys = mixed((sums[ends] - sums[starts]) * down[starts] + mixed(
        owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + lengths.astype(np.uint64)))
    size = 1 << (2 * n - 1).bit_length()
    slots, wanted = np.full(size, -1, dtype=np.int64), (keys & np.uint64(size - 1)).astype(np.int64)
    open_, holds = np.arange(n), np.zeros(n, dtype=bool)
    while len(open_):
        slot = wanted[open_]
        free = slots[slot] < 0
        slots[slot[free]] = open_[free]  # of several the last to write stays
        holder = slots[slot]
        mine = holder == open_
        holds[open_[mine]] = True
        alike = (keys[holder] == keys[open_]) & (owner[holder] == owner[open_]) & (lengths[holder] == lengths[open_]) & ~mine
        where = np.flatnonzero(alike)
        alike[where] = same_bytes(data, starts[holder[where]], starts[open_[where]], lengths[open_[where]])
        open_ = open_[~mine & ~alike]
        wanted[open_] = (wanted[open_] + 1) & (size - 1)
    return holds


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_chars", "n_symbols")


def _padded(data: bytes) -> np.ndarray:
    return np.frombuffer(data + bytes(8), dtype=np.uint8)


def count_block(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """The counts of some texts, a row each, with a gap byte set behind every text."""
    data = _padded(b" ".join(texts) + b" ")
    edges = np.cumsum([len(t) + 1 for t in texts])
    emitted, _ = transduce(data[: int(edges[-1])], table)
    starts, ends = np.flatnonzero(emitted & BEGINS), np.flatnonzero(emitted & ENDS)
    owner = np.searchsorted(edges, starts, "right")
    holds = first_of_equals(data, starts, ends, owner)

    def tally(places: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(edges, places, "right"), minlength=len(texts))
    points = tally(np.flatnonzero(emitted & IS_POINT)) - 1
    return np.stack([
        np.bincount(owner, minlength=len(texts)), np.bincount(owner[holds], minlength=len(texts)),
        tally(np.flatnonzero(emitted & IS_CAPITAL)), points, tally(np.flatnonzero(emitted & IS_SYMBOL))], axis=1)


def count_long(text: bytes, table: np.ndarray, block: int) -> np.ndarray:
    """The counts of one text, block by block: a word that crosses an edge is put together from the text."""
    words = capitals = points = symbols = 0
    seen: set[bytes] = set()
    state, opened = OUT, 0
    for at in range(0, len(text), block):
        part = text[at: at + block]
        data = _padded(part)
        emitted, after = transduce(data[: len(part)], table, state)
        starts, ends = np.flatnonzero(emitted & BEGINS), np.flatnonzero(emitted & ENDS)
        words += len(starts)
        if state == IN and len(ends):
            seen.add(text[opened: at + int(ends[0])])
            ends = ends[1:]
        whole = starts[: len(ends)]
        for s, e in zip(whole[(holds := first_of_equals(data, whole, ends, np.zeros(len(ends), np.int64)))], ends[holds]):
            seen.add(part[s:e])
        if len(starts) > len(ends):
            opened = at + int(starts[-1])
        state = after
        capitals += int(np.count_nonzero(emitted & IS_CAPITAL))
        points += int(np.count_nonzero(emitted & IS_POINT))
        symbols += int(np.count_nonzero(emitted & IS_SYMBOL))
    if state == IN:
        seen.add(text[opened:])
    return np.array([words, len(seen), capitals, points, symbols])


def text_counts(texts: list[bytes], symbols: str = SYMBOLS, block: int = BLOCK_BYTES) -> np.ndarray:
    """``COUNTS`` of each text, a row each, in blocks of bounded size."""
    table, made = class_table(symbols), np.zeros((len(texts), len(COUNTS)), dtype=np.int64)
    held: list[int] = []
    size = 0

    def finish():
        if held:
            made[held] = count_block([texts[i] for i in held], table)
            held.clear()
    for i, text in enumerate(texts):
        if len(text) > block:
            made[i] = count_long(text, table, block)
            continue
        if size + len(text) > block:
            finish()
            size = 0
        held.append(i)
        size += len(text) + 1
    finish()
    return made
