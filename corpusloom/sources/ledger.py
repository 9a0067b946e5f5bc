"""The ledger of datasets that were used already."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import strip
from corpusloom.session import delete_folder, list_folder, stage_table
from corpusloom.sources.commits import CommitLog

LEDGER = "name string"


def dataset_name(path: Column) -> Column:
    """File name of a path, without folders and without its last extension."""
    name = F.regexp_extract(path, r"([^/\\]*)\z", 1)
    return F.regexp_replace(name, r"(?s)\A(\.*[^.].*)\.[^.]*\z", "$1")


def new_names(names: DataFrame, ledger: DataFrame, column: str = "name") -> DataFrame:
    """Distinct names that are not in the ledger; whole names are compared."""
    distinct = names.select(F.col(column).alias("name")).distinct()
    logged = ledger.select(strip(F.col("name")).alias("name")).distinct()
    return distinct.join(logged, "name", "left_anti")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table, empty when nothing has been logged yet.

    It consists of the Parquet files right below ``path`` and of what the
    commit log names.  Only a path that is not there counts as an empty
    ledger; any other failure is raised, since taking it for empty would log
    everything again.
    """
    folders = [f"{path}/{name}" for name in CommitLog(spark, f"{path}/_commits").read()]
    try:
        if not folders or any(name.endswith(".parquet") for name in list_folder(spark, path)):
            folders.append(path)
        return spark.read.schema(LEDGER).parquet(*folders)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def log_datasets(spark: SparkSession, names: DataFrame, path: str, column: str = "name") -> bool:
    """Append the new names to the ledger; true when there were any.

    The names are written first and count when their commit has its number.
    If another writer has taken the number, they are compared with the ledger
    anew, so each name is logged once.
    """
    log = CommitLog(spark, f"{path}/_commits")
    names = stage_table(names.select(F.col(column).alias("name")).distinct(), "names")
    while True:
        number, folder = len(log.read()), f"_data-{uuid.uuid4().hex}"
        written = f"{path}/{folder}"
        new_names(names, read_ledger(spark, path)).write.parquet(written)
        if spark.read.schema(LEDGER).parquet(written).isEmpty():
            delete_folder(spark, written)
            return False
        if log.take(number, folder):
            return True
        delete_folder(spark, written)
