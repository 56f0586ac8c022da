"""Document collections as text: ``doc_id TAB text``, one document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text)``: only the first tab separates; lines without one are dropped."""
    fields = F.split("value", "\t", 2)
    lines = spark.read.text(path).where(F.contains("value", F.lit("\t")))
    return lines.select(fields[0].alias("doc_id"), fields[1].alias("text"))
