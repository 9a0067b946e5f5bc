"""A log of numbered commits beside a table: each number goes to the first who takes it."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusloom.session import list_folder


class CommitLog:
    """Commits in a folder, one small file each, named by its number.

    A commit is written under another name and renamed without overwriting,
    which is atomic on the file systems where the engine's own streaming log
    is.  Readers see whole commits only; data that no commit names doesn't exist.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> list[str]:
        """The texts of all commits, in order."""
        if not any(name.isdigit() for name in list_folder(self.spark, self.folder)):
            return []
        rows = self.spark.read.text(self.folder, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
        return [r["value"] for r in sorted(rows.collect(), key=lambda r: r["name"]) if r["name"].isdigit()]

    def take(self, number: int, text: str) -> bool:
        """Make ``text`` the commit of that number; false when another has it already."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        end = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number:012d}")
        begin = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_{uuid.uuid4().hex}")
        out = begin.getFileSystem(conf).create(begin, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(end.toUri(), conf)
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        qualified = [context.makeQualified(p) for p in (begin, end)]
        try:
            context.rename(*qualified, self.spark.sparkContext._gateway.new_array(kind, 0))
        except Py4JJavaError as error:
            begin.getFileSystem(conf).delete(begin, False)
            if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
                raise
            return False
        return True
