"""Row counts and column types of many Parquet files, from their footers."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TYPE_CONFLICT = "CANNOT_MERGE_SCHEMAS"


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, n_bytes`` of the Parquet files below a path; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("n_bytes"))


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """``file, n_rows, n_bytes`` of every Parquet file below a path, empty ones with 0.

    The scan asks for no column, so each task takes the numbers of rows from
    the footers of its files.
    """
    files = parquet_files(spark, path)
    place = F.col("_metadata.file_path")
    scan = spark.read.option("recursiveFileLookup", True).schema(StructType()).parquet(path)
    counted = scan.groupBy(place.alias("file")).agg(F.count("*").alias("n_rows"))
    none = files.select("file", F.lit(0).cast("bigint").alias("n_rows"), "n_bytes")
    return counted.select("file", "n_rows", F.lit(0).cast("bigint").alias("n_bytes")).unionByName(none).groupBy("file").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))


@dataclass
class FileGroup:
    """Files whose columns go together, and the columns."""

    schema: StructType
    files: list[str]


def file_groups(spark: SparkSession, files: list[str]) -> list[FileGroup]:
    """Files in groups whose types agree, few if few files differ.

    Footers are merged in one distributed scan.  If types contradict each
    other, the files are halved and each half is looked at alone; then groups
    that agree are put together.  So ``k`` odd files among ``n`` take about
    ``k * log(n)`` scans, and one if there is none.
    """
    if not files:
        return []
    try:
        return [FileGroup(spark.read.option("mergeSchema", True).parquet(*files).schema, list(files))]
    except (PySparkException, Py4JJavaError) as error:
        if TYPE_CONFLICT not in str(error) or len(files) == 1:
            raise
    middle = len(files) // 2
    groups: list[FileGroup] = []
    for group in [*file_groups(spark, files[:middle]), *file_groups(spark, files[middle:])]:
        mate = next((g for g in groups if _agree(g.schema, group.schema)), None)
        if mate is None:
            groups.append(group)
        else:
            names = set(mate.schema.names)
            mate.schema = StructType([*mate.schema.fields, *[f for f in group.schema.fields if f.name not in names]])
            mate.files += group.files
    return groups


def _agree(a: StructType, b: StructType) -> bool:
    kinds = {f.name: f.dataType for f in a.fields}
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in b.fields)


def type_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """``column, type, n_files, example`` of every column that has several types below a path, or is missing in some files.

    A missing column has the type ``missing``.  No conflicts give no rows.
    """
    files = sorted(r["file"] for r in parquet_files(spark, path).collect())
    groups = file_groups(spark, files)
    seen: dict[str, dict[str, list[str]]] = {}
    names = sorted({name for g in groups for name in g.schema.names})
    for group in groups:
        kinds = {f.name: f.dataType.simpleString() for f in group.schema.fields}
        for name in names:
            seen.setdefault(name, {}).setdefault(kinds.get(name, "missing"), []).extend(group.files)
    rows = [(name, kind, len(own), min(own)) for name, kinds in seen.items() if len(kinds) > 1 for kind, own in kinds.items()]
    return spark.createDataFrame(rows, "column string, type string, n_files int, example string")
