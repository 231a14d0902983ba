"""Shared scratch tables and durable stage tables."""

from __future__ import annotations

import contextlib
import hashlib
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # classes sent to executors name these functions

_LOCAL_SCRATCH: str | None = None  # only ever used with a local master


def _hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(jpath)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    global _LOCAL_SCRATCH
    _LOCAL_SCRATCH = _LOCAL_SCRATCH or tempfile.mkdtemp(prefix="firmweave-")
    return _LOCAL_SCRATCH


def cut_lineage(df: DataFrame, spread: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short plan, survives lost executors.

    ``spread`` keeps as many files as shuffle partitions, for small tables that
    much work is done on.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    if spread:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def tidy_shuffles(spark: SparkSession):
    """Shuffle files of a query begun in this block are deleted when it ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def release(*tables: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        own = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/"
        fs, home = _hadoop_path(spark, own)
        home = fs.makeQualified(home).toUri().getPath()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            fs, jpath = _hadoop_path(spark, folder)
            if jpath.toUri().getPath().startswith(home):
                fs.delete(jpath, True)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Files directly in ``folder``."""
    fs, jpath = _hadoop_path(spark, folder)
    return [s.getPath().toString() for s in fs.listStatus(jpath) if s.isFile()]


def fingerprint(spark: SparkSession, paths: list[str], *settings: object) -> str:
    """Digest of the files' names, sizes and times plus any settings; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return f"{content_digest(files.select('path', 'length', 'modificationTime'))}-{_digest(repr(settings))}"


def _digest(*parts: str) -> str:
    return hashlib.sha256("\x1e".join(parts).encode()).hexdigest()[:32]


def content_digest(df: DataFrame) -> str:
    """Row count and a digest of the rows in any order, column names and types included."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    row = F.to_json(F.struct(*plain.columns), {"ignoreNullFields": "false"}) if plain.columns else F.lit("")
    wide = lambda seed: F.sum(F.xxhash64(row, F.lit(seed)).cast("decimal(38,0)"))
    found = plain.agg(F.count(F.lit(1)).alias("n"), wide(0).alias("x"), wide(1).alias("y")).first()
    return _digest(df.schema.json(), *map(str, found))


@contextlib.contextmanager
def _whole_texts(spark: SparkSession):
    """Plan texts with all fields and list items, which Spark else shortens."""
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, 2**31 - 1)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _items(seq) -> list:
    """Elements of a JVM sequence."""
    return [seq.apply(i) for i in range(seq.size())]


def _plan_digest(spark: SparkSession, plan) -> str:
    """Digest of a resolved plan: its operators with all literals, its leaves by their files or rows, subqueries alike.

    Expression numbers and aliases of tables are made comparable first. Files are told by name, size and time; any
    other leaf (rows given by the driver, a table of another source) by its rows.
    """
    parts: list[str] = []

    def operators(node) -> None:
        children = _items(node.children())
        # leaves show the addresses of what they hold; they are told by their content below
        parts.append(node.simpleString(2**31 - 1) if children else node.nodeName())
        parts.extend(_plan_digest(spark, inner) for inner in _items(node.subqueries()))
        for child in children:
            operators(child)
        parts.append("end")

    operators(plan.canonicalized())
    session = spark._jsparkSession
    for leaf in _items(plan.collectLeaves()):
        rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, leaf), spark)
        files = rows.inputFiles()
        parts.append(fingerprint(spark, files) + rows.schema.json() if files else content_digest(rows))
    return _digest(*parts)


def plan_digest(df: DataFrame) -> str:
    """What ``df`` is computed from and how, so that equal digests mean equal rows.

    A plan with user functions cannot be told by its text, so its rows are. Values that Spark sets when a plan runs
    (the time, unseeded random numbers) do not count.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    patterns = spark._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    inner = [plan, *_items(plan.subqueriesAll())]
    if any(p.containsPattern(getattr(patterns, kind)()) for p in inner for kind in ("PYTHON_UDF", "SCALA_UDF")):
        return content_digest(df)
    with _whole_texts(spark):
        return _digest(_plan_digest(spark, plan), df.schema.json())


class StageTables:
    """Parquet tables of one run, each under a key of everything it was computed from.

    A finished table is reused while its inputs and settings, and those of all
    stages before it, stay the same.
    """

    def __init__(self, spark: SparkSession, out_dir: str, version: str = ""):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self.key = _digest(version)
        self.reused: list[str] = []

    def depends_on(self, *inputs: object) -> None:
        """Mix inputs into the key: folders or files (by metadata), DataFrames (by their files, plan and rows), settings."""
        for item in inputs:
            if isinstance(item, DataFrame):
                part = plan_digest(item)
            elif isinstance(item, str) and exists(self.spark, item):
                part = fingerprint(self.spark, [item])
            else:
                part = repr(item)
            self.key = _digest(self.key, type(item).__name__, part)

    def table(
        self, stage: str, build: Callable[[], DataFrame], measure: dict[str, Column] | None = None
    ) -> tuple[DataFrame, dict]:
        """The stage's table and its measures, taken while writing it unless it is already there."""
        path = f"{self.out_dir}/{stage}/{self.key}"
        named = [c.alias(n) for n, c in (measure or {}).items()]
        if exists(self.spark, f"{path}/_SUCCESS"):
            self.reused.append(stage)
            df = self.spark.read.parquet(path)
            return df, df.agg(*named).first().asDict() if named else {}
        df = build()
        if named:
            seen = Observation()
            df = df.observe(seen, *named)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path), seen.get if named else {}


def append_metrics(spark: SparkSession, path: str, metrics: dict) -> None:
    """Append one ``{timestamp, metrics}`` JSON line for a run."""
    fields = [F.lit(v).alias(k) for k, v in metrics.items()]
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    spark.range(1).select(now.alias("timestamp"), F.struct(*fields).alias("metrics")).write.mode("append").json(path)
