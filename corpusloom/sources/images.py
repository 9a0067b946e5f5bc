"""Image columns and image files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.containers import image_state
from corpusloom.session import ship_package

# The first bytes of the common image formats, in hex.
SIGNATURES = {
    "png": "89504E470D0A1A0A", "jpeg": "FFD8FF", "gif87": "474946383761", "gif89": "474946383961",
    "tiff_le": "49492A00", "tiff_be": "4D4D002A",
}
BMP_HEADERS = [12, 16, 40, 52, 56, 64, 108, 124]  # sizes of the second header


def looks_like_image(content: Column) -> Column:
    """Whether the bytes begin like an image file.

    A WEBP file has its name behind the RIFF header; a bitmap has four unused
    zero bytes and a second header of a known size.
    """
    def at(first: int, size: int) -> Column:
        return F.hex(F.substring(content, first, size))
    known = at(1, 4).eqNullSafe("52494646") & (at(9, 4) == "57454250")
    for signature in SIGNATURES.values():
        known = known | at(1, 8).startswith(signature)
    sizes = [f"{size:02X}000000" for size in BMP_HEADERS]
    bitmap = (at(1, 2) == "424D") & (at(7, 4) == "00000000") & at(15, 4).isin(sizes)
    return F.coalesce(known | bitmap, F.lit(False))


def readable(df: DataFrame, column: str) -> Column:
    """Whether an image column holds an image: bytes, a (bytes, path) struct, or a decoded image struct.

    Paths say nothing about a file; :func:`resolve_paths` replaces them first.
    """
    kind = df.schema[column].dataType
    if kind.simpleString() == "string":
        raise ValueError(f"{column} holds paths; resolve them with a table of files")
    names = kind.names if kind.typeName() == "struct" else []
    if "bytes" in names:
        return looks_like_image(F.col(f"{column}.bytes"))
    if {"data", "width", "height"} <= set(names):
        sound = (F.length(f"{column}.data") > 0) & (F.col(f"{column}.width") > 0) & (F.col(f"{column}.height") > 0)
        return F.coalesce(sound, F.lit(False))
    return looks_like_image(F.col(column))


def keep_readable(df: DataFrame, column: str = "image", files: DataFrame | None = None) -> DataFrame:
    """Drop rows without a readable image; paths are looked up in ``files``."""
    df = df if files is None else resolve_paths(df, files, column)
    return df.filter(readable(df, column))


def image_report(df: DataFrame, column: str = "image", files: DataFrame | None = None) -> DataFrame:
    """Rows and rows dropped for an unreadable image."""
    df = df if files is None else resolve_paths(df, files, column)
    return df.agg(F.count("*").alias("n_rows"), F.count_if(~readable(df, column)).alias("n_dropped"))


def image_states(df: DataFrame, column: str = "image", files: DataFrame | None = None) -> DataFrame:
    """Add ``format`` and ``problem`` of each image, from a walk over the whole file.

    ``problem`` is null for a file that holds together, else ``empty``,
    ``format``, ``truncated``, ``checksum``, ``pixels`` or the part that is
    wrong.  Paths are looked up in ``files``; a path without a file is
    ``empty``.  Files come to Python in Arrow batches of ``maxRecordsPerBatch``.
    """
    df = df if files is None else resolve_paths(df, files, column)
    kind = df.schema[column].dataType
    if kind.simpleString() == "string":
        raise ValueError(f"{column} holds paths; resolve them with a table of files")
    content = F.col(f"{column}.bytes") if kind.typeName() == "struct" else F.col(column)
    ship_package(df.sparkSession)

    @F.pandas_udf("format string, problem string")
    def states(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_state(None if data is None else bytes(data)) for data in files], columns=["format", "problem"])
    return df.withColumn("_state", states(content)).select(*df.columns, "_state.format", "_state.problem")


def keep_sound(df: DataFrame, column: str = "image", files: DataFrame | None = None) -> DataFrame:
    """Drop rows whose image is missing, truncated or damaged; what only begins like an image goes, too."""
    return image_states(df, column, files).filter("problem IS NULL").drop("format", "problem")


def damage_report(df: DataFrame, column: str = "image", files: DataFrame | None = None) -> DataFrame:
    """Number of rows for each format and problem."""
    return image_states(df, column, files).groupBy("format", "problem").agg(F.count("*").alias("n_rows"))


def resolve_paths(df: DataFrame, files: DataFrame, column: str = "image") -> DataFrame:
    """Fill missing bytes of a (bytes, path) column, or of a column of paths, from a table of files.

    ``files`` has ``path`` and ``content``, as ``spark.read.format("binaryFile")``
    gives them.  Only rows that need a file take part in the join; the others
    would all meet in one task with their missing path.
    """
    if df.schema[column].dataType.simpleString() == "string":
        packed = F.struct(F.lit(None).cast("binary").alias("bytes"), F.col(column).alias("path"))
        df = df.withColumn(column, packed)
    missing = F.col(f"{column}.bytes").isNull() & F.col(f"{column}.path").isNotNull()
    found = files.select(F.col("path").alias("_path"), F.col("content").alias("_content"))
    filled = df.filter(missing).withColumn("_path", F.col(f"{column}.path")).join(found, "_path", "left")
    image = F.struct(F.col("_content").alias("bytes"), F.col("_path").alias("path"))
    return filled.withColumn(column, image).select(*df.columns).unionByName(df.filter(~missing))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded image files; unreadable ones are dropped by the reader."""
    return spark.read.format("image").option("dropInvalid", True).load(path)
