"""Session set-up and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_shipped: set[str] = set()
_scratch: list[str] = []


def local_session(cores: int | str = 8, memory: str = "12g", app: str = "corpusloom") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and stream checkpoints.

    The session's ``spark.checkpoint.dir`` is used when it is set.  Only a
    local master, where every task sees the same disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def new_scratch(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession, before: int = 0) -> int:
    """Delete what was staged since mark ``before``, and return how many paths that were.

    For a caller who is done with the results: a table that was built on staged
    ones can't be read afterwards.  ``scratch_mark`` gives the mark.
    """
    gone = _scratch[before:]
    for path in gone:
        delete_folder(spark, path)
    del _scratch[before:]
    return len(gone)


def scratch_mark() -> int:
    """How many scratch paths were given out so far."""
    return len(_scratch)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch folder that is deleted at the end, for tables that only lead to one that is staged elsewhere."""
    path = new_scratch(spark, name)
    try:
        yield path
    finally:
        delete_folder(spark, path)


def stage_table(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once, into ``folder`` if one is given, and read it back.

    Used where two later passes need the same costly columns: the table cuts
    the lineage, survives lost executors, and lets each pass read only the
    columns it needs.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else new_scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, none if there is no such folder."""
    files, at = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that has fewer splits than the cluster has cores.

    A big table has far more splits than cores and is left alone, so this
    never adds a shuffle at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor.

    Called by the operators that run Python inside tasks; sends a small zip
    once per Spark application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/corpusloom", "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
