"""Writing tokenized rows with fixed types."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.labels import IDS
from corpusloom.session import delete_folder
from corpusloom.sources.commits import CommitLog

TOKEN_COLUMNS = ["input_ids", "attention_mask", "labels"]
ROW_BYTES = 8 * len(TOKEN_COLUMNS)    # of one token, before compression


def typed_tokens(df: DataFrame) -> DataFrame:
    """Token lists as 64-bit numbers and the length as a 32-bit one."""
    lists = {c: F.col(c).cast(IDS) for c in TOKEN_COLUMNS}
    return df.withColumns({**lists, "length": F.col("length").cast("int")})


def write_tokens(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write the typed rows; rows stream out, so no task holds a whole file."""
    typed_tokens(df).write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def _groups(files: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Files in order of their path, as many together as fit into ``most`` bytes."""
    made: list[list[str]] = []
    room = 0
    for path, size in sorted(files):
        if not made or size > room:
            made.append([])
            room = most
        made[-1].append(path)
        room -= size
    return made


def export_tokens(
    spark: SparkSession, source: str, make: Callable[[DataFrame], DataFrame], path: str, max_length: int,
    group_bytes: int = 64 << 30, file_bytes: int = 512 << 20,
) -> int:
    """Tokenize the Parquet files below ``source`` into ``path``, some at a time; the number of groups that this call did.

    ``make`` turns rows into tokenized ones of at most ``max_length`` tokens.
    The files are taken in groups of about ``group_bytes``; each is one job,
    and its rows count once the log names their folder together with the
    files they come from.  A call after a failure goes on with the files that
    the log doesn't name, and new files are simply further ones.  If two calls
    run at once, the first to commit a file has it.  No file holds more than
    ``file_bytes`` before compression.
    """
    log = CommitLog(spark, f"{path}/_commits")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(
        source).select("path", "length").collect()  # a name per file, as the scan itself lists them
    rows_per_file = max(1, file_bytes // (ROW_BYTES * max_length))

    def taken() -> tuple[int, set[str]]:
        commits = [json.loads(text) for text in log.read()]
        return len(commits), {f for c in commits for f in c["files"]}
    _, known = taken()
    groups = _groups([(r["path"], r["length"]) for r in listed if r["path"] not in known], group_bytes)
    done = 0
    for files in groups:
        folder = f"data-{uuid.uuid4().hex}"
        write_tokens(make(spark.read.parquet(*files)), f"{path}/{folder}", rows_per_file)
        while True:
            number, known = taken()
            if known & set(files):
                delete_folder(spark, f"{path}/{folder}")
                break
            if log.take(number, json.dumps({"folder": folder, "files": files})):
                done += 1
                break
    return done


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all groups that were committed."""
    folders = [json.loads(text)["folder"] for text in CommitLog(spark, f"{path}/_commits").read()]
    if not folders:
        raise FileNotFoundError(f"nothing was exported to {path}")
    return spark.read.parquet(*[f"{path}/{folder}" for folder in folders])
