"""Query sets: a text file with one query per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_query_set(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """``(query)`` without white space at both ends; blank lines stay as empty queries.

    With ``position``, a column that sorts the queries as the files hold them: file, start of the split, row there.
    """
    query = F.regexp_replace("value", r"\A\s+|\s+\z", "").alias("query")
    lines = spark.read.text(path)
    if not position:
        return lines.select(query)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return lines.select(query, place.alias("position"))


def request_text(query: Column) -> Column:
    """The words of a query joined by ``+``, as a search request takes them."""
    return F.array_join(F.array_remove(F.split(query, r"\s+"), ""), "+")
