"""Inverted indexes as text: ``term TAB doc:count doc:count ...``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchloom.operators.textindex import parse_postings, posting_text


def write_index(blocks: DataFrame, path: str, part_files: int | None = None) -> None:
    """Write posting blocks, a line each, sorted by term within a part file.

    The files are as many as the partitions of ``blocks``, unless a number is asked for (``fixed.INDEX_PART_FILES``, for
    one); lines are then dealt out by ``(term, block)``, so a term with many blocks is spread over the files.
    """
    line = F.concat_ws("\t", "term", posting_text(F.col("postings")))
    (
        (blocks if part_files is None else blocks.repartition(part_files, "term", "block"))
        .sortWithinPartitions("term", "block")
        .select(line.alias("value"))
        .write.mode("overwrite").text(path)
    )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``(term, doc_id, n)``, a row per posting."""
    return parse_postings(spark.read.text(path))
