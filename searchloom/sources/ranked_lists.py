"""Ranked result lists as JSON objects ``{query: [url, ...]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES_PER_OBJECT = 10_000


def _objects(spark: SparkSession, path: str, one_object_per_file: bool) -> DataFrame:
    """``(file, value, lists, good)``: the objects of the files, blank lines left out."""
    objects = spark.read.text(path, wholetext=one_object_per_file).select(F.col("_metadata.file_name").alias("file"), "value")
    parsed = objects.where(F.trim(F.col("value")) != "").withColumn("lists", F.from_json("value", "map<string,array<string>>"))
    whole = ~F.exists(F.map_values("lists"), lambda urls: urls.isNull())
    return parsed.withColumn("good", F.coalesce(F.col("lists").isNotNull() & whole, F.lit(False)))


def read_ranked_lists(spark: SparkSession, path: str, one_object_per_file: bool = False, bad_rows: str = "fail") -> DataFrame:
    """``(query, urls)`` from one JSON object per line, or from indented one-object files.

    What is no such object, or holds something else than lists, ends the job with its text. With ``bad_rows="drop"``
    it is left out; :func:`bad_ranked_lists` lists it.
    """
    if bad_rows not in ("fail", "drop"):
        raise ValueError(f"bad_rows is fail or drop, not {bad_rows}")
    good = F.col("good")
    if bad_rows == "fail":
        told = F.concat(F.lit("no object of ranked lists: "), F.substring("value", 1, 1000))
        good = F.when(good, True).otherwise(F.raise_error(told).cast("boolean"))
    return _objects(spark, path, one_object_per_file).where(good).select(F.explode("lists").alias("query", "urls"))


def bad_ranked_lists(spark: SparkSession, path: str, one_object_per_file: bool = False) -> DataFrame:
    """``(file, row)``: the lines, or files, that :func:`read_ranked_lists` refuses, as written."""
    return _objects(spark, path, one_object_per_file).where(~F.col("good")).select("file", F.col("value").alias("row"))


def write_ranked_lists(lists: DataFrame, path: str, queries_per_object: int = QUERIES_PER_OBJECT) -> None:
    """Write ``(query, urls)``, a query once; many queries make many objects, one per line."""
    n_objects = max(1, -(-lists.count() // queries_per_object))
    (
        lists.groupBy(F.pmod(F.xxhash64("query"), F.lit(n_objects)).alias("object"))
        .agg(F.map_from_entries(F.collect_list(F.struct("query", "urls"))).alias("lists"))
        .select(F.to_json("lists").alias("value"))
        .write.mode("overwrite").text(path)
    )
