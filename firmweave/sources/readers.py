"""Raw company files: CSV with differing headers, JSON lines, Parquet, tolerant bulk CSV."""

from __future__ import annotations

import contextlib
import csv
import sys
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from firmweave.storage import exists, list_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# File extension of each raw format.
EXTENSIONS = {"csv": ".csv", "jsonl": ".jsonl", "parquet": ".parquet"}


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


@contextlib.contextmanager
def _a_task_for_each_file(spark: SparkSession):
    """Files are neither cut nor put together while a job runs."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(2**60))
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def _first_line(batches):
    """The first row of a file; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _column_names(line: str, quote: str) -> tuple[str, ...]:
    """Names in a header line; empty and repeated ones are told apart by their place."""
    line = line.removeprefix("\ufeff")
    found = next(csv.reader([line], quotechar=quote, doublequote=True), []) if quote else line.split(",")
    folded = [x.lower() for x in found]
    return tuple(f"_c{i}" if not x else f"{x}{i}" if folded.count(x.lower()) > 1 else x for i, x in enumerate(found))


def _by_header(spark: SparkSession, paths: list[str], quote: str) -> list[tuple[list[str], list[str]]]:
    """Files grouped by header line, which one job reads; Spark applies one header by position to all files of a read."""
    names = {spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath(): p for p in paths}
    with _a_task_for_each_file(spark):
        lines = spark.read.text(paths).select("value", "_metadata.file_path").mapInArrow(_first_line, "value string, file_path string").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for line in sorted(lines, key=lambda r: r["file_path"]):
        path = spark._jvm.java.net.URI(line["file_path"]).getPath()
        if line["value"]:
            groups.setdefault(_column_names(line["value"], quote), []).append(names[path])
    return [(list(header), members) for header, members in groups.items()]


def _with_line_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """Files in which a line has an odd number of quotes, so a quoted field may go on in the next line."""
    odd = spark.read.text(paths).filter(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1)
    found = {spark._jvm.java.net.URI(r[0]).getPath() for r in odd.select("_metadata.file_path").distinct().collect()}
    return {p for p in paths if spark._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath() in found}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(spark: SparkSession, paths: list[str], multiline: bool | None = None) -> DataFrame:
    """All files as text columns, united by column name; rows that do not fit are skipped.

    Files are read in splits. Those in which a quoted field may hold a line break are read whole, one task
    each; they are found by their quotes, unless ``multiline`` says that all files (True) or none (False) are such.
    """
    whole = _with_line_breaks(spark, paths) if multiline is None else set(paths) if multiline else set()
    reader = lambda header, unsplit: spark.read.schema(_strings(header)).options(
        header=True, mode="DROPMALFORMED", columnPruning=False, multiLine=unsplit, quote='"', escape='"')
    frames = []
    for header, members in _by_header(spark, paths, '"'):
        for unsplit in (False, True):
            if some := [p for p in members if (p in whole) == unsplit]:
                frames.append(reader(header, unsplit).csv(some))
    return _union(frames)


def read_bulk_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Large reference CSV without quoting: every line is a row, ragged lines are cut or padded."""
    frames = [
        spark.read.schema(_strings(header)).options(header=True, quote="", mode="PERMISSIVE").csv(members)
        for header, members in _by_header(spark, paths, "")
    ]
    return _union(frames)


def read_jsonl(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(paths)


def read_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files, united by column name; a column whose types cannot be merged is read as text."""
    try:
        # one job reads all footers; columns that only some files have are null elsewhere
        return spark.read.option("mergeSchema", True).parquet(*paths)
    except (PySparkException, Py4JJavaError):
        groups: dict[str, tuple[T.StructType, list[str]]] = {}
        for path in paths:
            schema = spark.read.parquet(path).schema
            groups.setdefault(schema.json(), (schema, []))[1].append(path)
        kinds: dict[str, set[str]] = {}
        for schema, _ in groups.values():
            for f in schema:
                kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
        mixed = {name for name, found in kinds.items() if len(found) > 1}
        return _union([
            spark.read.schema(schema).parquet(*members).withColumns({f.name: F.col(f.name).cast("string") for f in schema if f.name in mixed})
            for schema, members in groups.values()
        ])


def raw_files(spark: SparkSession, raw_dir: str) -> dict[str, list[str]]:
    """Files of each known format directly in ``raw_dir``."""
    if not exists(spark, raw_dir):
        raise ValueError(f"no such folder: {raw_dir}")
    names = list_files(spark, raw_dir)
    found = {kind: [p for p in names if p.endswith(ext)] for kind, ext in EXTENSIONS.items()}
    found = {kind: sorted(paths) for kind, paths in found.items() if paths}
    if not found:
        raise ValueError(f"no CSV, JSON lines or Parquet files in {raw_dir}")
    return found


def read_raw(spark: SparkSession, raw_dir: str, **csv_options) -> dict[str, DataFrame]:
    """One DataFrame for each format present in ``raw_dir``."""
    files = raw_files(spark, raw_dir)
    readers = {
        "csv": lambda p: read_csv(spark, p, **csv_options),
        "jsonl": lambda p: read_jsonl(spark, p),
        "parquet": lambda p: read_parquet(spark, p),
    }
    return {kind: readers[kind](paths) for kind, paths in files.items()}


def reference_table(
    df: DataFrame, name: str = "name", domain: str = "domain", industry: str | None = "industry"
) -> DataFrame:
    """Lookup columns under their common names."""
    return df.select(
        F.col(name).cast("string").alias("ref_name"),
        F.col(domain).cast("string").alias("ref_domain"),
        (F.col(industry) if industry else F.lit(None)).cast("string").alias("ref_industry"),
    )


def seed_domain(entities: DataFrame) -> DataFrame:
    """Give entities a ``domain`` from the first website column they have."""
    if "domain" in entities.columns:
        return entities
    source = next((c for c in ("primary_website", "website") if c in entities.columns), None)
    value = F.col(source) if source else F.lit(None)
    return entities.withColumn("domain", value.cast("string"))
