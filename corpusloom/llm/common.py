"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ship_package

# A word is a run of anything but ASCII white space; bytes.split() cuts exactly there.
WHITE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def read_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator works on; others, whatever their names, stay out of its way."""
    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), *more)


def fresh(name: str, columns: Iterable[str]) -> str:
    """A column name that is not among ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


PART_ROWS = 1000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> None:
    """Prepare a session for work on texts in Python tasks.

    The package is shipped, and Arrow batches are held to ``PART_ROWS`` rows:
    ten thousand whole texts at once, the default, take too much memory on both
    sides of the pipe.
    """
    ship_package(spark)
    if not 0 < int(spark.conf.get(BATCH_CONF)) <= PART_ROWS:
        spark.conf.set(BATCH_CONF, str(PART_ROWS))


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], least: int
) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches, of at least ``least`` rows but for the last.

    A group that a batch cuts off is held until it is whole.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(rows, dtype=bool)
        for key in keys:
            values = table[key].to_numpy()
            last &= values == values[-1]
        cut = int(np.argmax(last))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows -= cut
    if rows:
        yield pa.Table.from_batches(held)
    pa.default_memory_pool().release_unused()


def map_rows(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None], schema
) -> DataFrame:
    """``mapInArrow`` with a function of up to ``PART_ROWS`` rows.

    Small parts bound the memory of a task, and what Arrow still holds at its
    end is given back, since the worker lives on.
    """
    ready(df.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                made = make(batch.slice(at, PART_ROWS))
                if isinstance(made, pa.RecordBatch):
                    yield made
                elif made is not None:
                    yield from made
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def record(**columns) -> pa.RecordBatch:
    """A record batch from named arrays or lists."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)
    )


def word_array(text: Column) -> Column:
    """The words of a text as a native array; null and blank texts have none."""
    cut = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    return F.filter(cut, lambda w: w != "")

