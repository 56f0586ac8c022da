"""Every entry in Python workers that no earlier stage has warmed, as after the loss of an executor."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
    .config("spark.python.worker.reuse", "false").config("spark.checkpoint.dir", {folder!r}).config("spark.sql.warehouse.dir", {folder!r}).getOrCreate()
)
import __spark_entry__
for name in {names!r}:
    print("ROWS", name, __spark_entry__.queries()[name](spark, {folder!r}).count(), flush=True)
"""


@pytest.fixture(scope="module")
def tables(spark, docs, labels, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    known = docs.select("doc_id", "text").where("doc_id < 45").selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars")
    known.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_entries_in_fresh_workers(tables):
    from searchloom.llm import queries

    names = [*queries.QUERIES, "pipeline"]
    code = RUN.format(root=str(ROOT), folder=tables, names=names)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=1500, env=os.environ | {"PYSPARK_PYTHON": sys.executable})
    found = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ROWS")]
    assert found == names, done.stderr[-3000:]
