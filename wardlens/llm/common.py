"""Shared pieces: written intermediates, ASCII lower case, word splitting."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import string
import sys
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import shared_dir


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, as ``--py-files`` would, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_wardlens_shipped", False):
        return
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="wardlens-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(os.path.join(home, "wardlens"), os.path.join(folder, "src", "wardlens"),
                    ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "wardlens"), "zip",
                                     os.path.join(folder, "src")))
    sc._wardlens_shipped = True


class Workspace:
    """A fresh folder under the shared checkpoint folder for one operator run.

    Intermediates that are read more than once are written there as Parquet
    and read back, which also cuts the lineage: a lost executor costs at most
    the tasks since the last written table.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.root = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        df.write.mode("overwrite").options(**options).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def discard(self, *names: str) -> None:
        """Delete written tables that nothing reads any more."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def hand_back() -> None:
    """Hands freed memory of this process back to the system."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def give_back(run):
    """A function of Arrow batches that hands its freed memory back to the
    system after each task. Spark keeps Python workers for later tasks; without
    this an idle one holds the most that it ever needed."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            hand_back()
    return wrapped


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def split_words(text: Column, separators: str) -> Column:
    """Non-empty runs between matches of ``separators`` (a regex); null text
    has no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")
