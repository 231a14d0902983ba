"""Operators on executors whose Python has no copy of the package, and texts that are no UTF-8."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
RUN = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.checkpoint.dir", {folder!r}).config("spark.ui.showConsoleProgress", "false").getOrCreate())
alone = spark.range(1).mapInArrow(lambda batches: __import__("firmweave"), "id bigint")
try:
    alone.collect()
    print("the workers have the package")
except Exception as e:
    assert "No module named" in str(e), e
rows = [(i, "some words of the text number %d and more. " % i * (i % 7), ["en", "de"][i % 2], i % 3 and 1) for i in range(40)]
docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, quality int")
bad = spark.range(1).select((F.col("id") + 100).alias("doc_id"), F.expr("cast(X'612062ff2063' as string)").alias("text"), F.lit("en").alias("lang"), F.lit(1).alias("quality"))
docs.union(bad).write.parquet({folder!r} + "/documents.parquet")
docs.select("doc_id", "quality").write.parquet({folder!r} + "/labels.parquet")
spark.createDataFrame([(0, "nothing of the kind is in any of these short texts here")], "item_id bigint, text string").write.parquet({folder!r} + "/benchmark.parquet")
spark.createDataFrame([(0, 0, "user", "a b"), (1, 0, "user", "a b")], "conv_id bigint, turn bigint, role string, text string").write.parquet({folder!r} + "/conversations.parquet")
import __spark_entry__
for name in {names!r}:
    print(name, __spark_entry__.queries()[name](spark, {folder!r}).count())
"""
NAMES = [
    "op1_simhash_dedup", "op2_substring_dedup", "op3_language_id", "op6_token_files", "op7_quality", "op8_byte_pair_encoding",
    "op11_quality_rules", "op12_conversation_trie", "op13_spelling_variants", "pipeline",
]


def test_workers_without_the_package(tmp_path):
    (tmp_path / "elsewhere").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = RUN.format(repo=REPO, folder=str(tmp_path), names=NAMES)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "elsewhere", env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    found = dict(x.split() for x in done.stdout.splitlines() if x.startswith(("op", "pipeline")))
    assert "the workers have" not in done.stdout and set(found) == set(NAMES)
    assert all(found[x] == "41" for x in NAMES if x[2] in "136781" and x[:4] not in ("op12", "op13")), found
