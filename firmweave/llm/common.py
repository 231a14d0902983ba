"""What several corpus operators share: files of whole byte strings, and row numbers."""

from __future__ import annotations

import contextlib
import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmweave.storage import shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


class Shared:
    """An object sent once to each executor; its class travels with it, so executors need no copy of the package.

    Spark's own broadcast names classes by their module. A worker process makes the object once and keeps it.
    """

    def __init__(self, spark: SparkSession, thing: object):
        self.pickled = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    @property
    def value(self):
        kept = self.pickled.__dict__
        if "_made" not in kept:
            kept["_made"] = cloudpickle.loads(self.pickled.value)
            if kept.get("_python_broadcast") is None and kept.get("_jbroadcast") is None:
                kept.pop("_value", None)  # on an executor, the bytes are in Spark's file
        return kept["_made"]


def whole_text(value: bytes | None) -> str | None:
    """A text from its bytes; what is no UTF-8 becomes U+FFFD."""
    return None if value is None else value.decode("utf-8", "replace")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """At most ``rows`` rows in an Arrow batch while a job runs: whole texts and files can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_files(df: DataFrame, column: str, path: str) -> None:
    """One file for each row of binary ``column``: its bytes and one line feed.

    Spark's own writer and committer are used, so a lost executor leaves no half
    file and any file system Spark knows will do. The formats written this way
    (ZIP with a one-byte comment, Arrow streams) allow for the last byte.
    """
    df.select(F.col(column).cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the files that ``write_files`` made."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        .filter("length > 0").select("path", "content")
    )
