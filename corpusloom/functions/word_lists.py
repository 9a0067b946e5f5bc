"""White-space tokens of many texts at once, for tasks.

``str.split`` and the pattern of ``functions.text.words`` know the same white
space, and splitting, counting and looking up a token in Python takes a small
part of the time that a row-wise Spark expression takes for it.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MOST_COUNTED = 500_000   # different tokens that a task counts before it passes them on


def split_texts(texts: pa.Array) -> Iterator[list[str]]:
    """The tokens of each text; a null has none.  A few texts at a time are unpacked."""
    for at in range(0, len(texts), 256):
        some = texts.slice(at, 256)
        try:
            values = some.to_pylist()
        except UnicodeDecodeError:  # what is no text becomes replacement signs, as in Java
            raw = some.cast(pa.large_binary() if pa.types.is_large_string(some.type) else pa.binary())
            values = [v and v.decode("utf-8", "replace") for v in raw.to_pylist()]
        for value in values:
            yield value.split() if value else []


def token_counts(texts: pa.Array, n_special: int) -> pa.Array:
    return pa.array([len(found) + n_special for found in split_texts(texts)], pa.int32())


def count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, n`` from batches of texts; a token comes once for each stretch of ``MOST_COUNTED`` different ones."""
    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])
    counts: dict[str, int] = {}
    known = counts.get
    for batch in batches:
        for found in split_texts(batch.column(0)):
            for token in found:
                counts[token] = known(token, 0) + 1
            if len(counts) >= MOST_COUNTED:
                yield passed_on()
                counts.clear()
    if counts:
        yield passed_on()


def coded_texts(
    texts: pa.Array, rooms: pa.Array, known: dict[str, int], unknown: int, begin: list[int],
) -> pa.Array:
    """``input_ids``, cut to the room that each text has after ``begin``, and ``length`` before the cut."""
    ids, ends, sizes, get = array("q"), [0], [], known.get
    for found, room in zip(split_texts(texts), rooms.to_pylist()):
        ids.extend(begin)
        ids.extend([get(token, unknown) for token in found[:room]])
        ends.append(len(ids))
        sizes.append(len(found) + len(begin))
    numbers = pa.array(np.frombuffer(ids, dtype=np.int64) if ids else np.empty(0, dtype=np.int64))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), numbers)
    return pa.StructArray.from_arrays([lists, pa.array(sizes, pa.int32())], ["input_ids", "length"])
