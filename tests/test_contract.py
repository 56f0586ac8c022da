import subprocess
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
import check  # noqa: E402
import driver_queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_agrees_with_its_sql(spark, tables, name):
    verdict = check.compare(spark, tables, SF_DIR, name)
    assert verdict.startswith(("same", "rows only")), verdict


def test_only_the_approximate_searches_have_no_sql():
    assert set(driver_queries.QUERIES) - set(driver_queries.ORACLES) == {"vec_topk_lsh", "rag_context_index"}
    assert set(driver_queries.QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["term", "block", "n_docs", "postings"] and not result.isEmpty()


def test_python_workers_find_the_package_from_any_folder(tmp_path):
    root = Path(contract.__file__).resolve().parent
    program = f"""
import sys
sys.path.insert(0, {str(root)!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
print("rows", contract.queries()["model_fanout"](spark, {SF_DIR!r}).count())
"""
    done = subprocess.run(
        [sys.executable, "-c", program], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "rows 80" in done.stdout, done.stderr[-2000:]
