"""Crawl logs and ranking statistics as CSV with a header."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom import fixed_values as fixed

# A status stays text: next to numbers it may be the word for a failed fetch.
FETCH_LOG = T.StructType().add("url", "string").add("status", "string")
VISIT_LOG = (
    T.StructType().add("url", "string").add("size", "long")
    .add("out_links", "integer").add("content_type", "string")
)
URL_LOG = T.StructType().add("url", "string").add("valid", "string")

_HEADERS = {
    "fetch": (FETCH_LOG, fixed.FETCH_LOG_HEADER),
    "visit": (VISIT_LOG, fixed.VISIT_LOG_HEADER),
    "urls": (URL_LOG, fixed.URL_LOG_HEADER),
}
# Quotes are doubled, and blanks belong to the value.
_DIALECT = {
    "quote": '"', "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


_BAD = "_bad_row"


def _parsed(spark: SparkSession, kind: str, path: str, multi_line: bool) -> DataFrame:
    """The fields as text, and ``_bad_row``: the text of a row that isn't as it should be.

    Spark judges only the fields that a query asks for, so whole numbers are tested here, and all fields are read.
    """
    schema, _ = _HEADERS[kind]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_BAD, T.StringType())])
    rows = (
        spark.read.schema(texts).options(**_DIALECT).option("header", True).option("enforceSchema", True)
        .option("multiLine", multi_line).option("columnPruning", False)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD).csv(path)
    )
    numbers = [f for f in schema.fields if f.dataType != T.StringType()]
    wrong = reduce(lambda a, b: a | b, (
        (F.col(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull() for f in numbers
    ), F.length(schema.names[0]) < 0)  # never so, but a query must not ask for the bad rows' text alone
    text = F.coalesce(_BAD, F.when(wrong, F.concat_ws(",", *schema.names)))
    return rows.select("*", F.col("_metadata.file_name").alias("_file")).withColumn(_BAD, text)


def read_log(spark: SparkSession, kind: str, path: str, multi_line: bool = False, bad_rows: str = "fail") -> DataFrame:
    """Read a ``fetch``, ``visit`` or ``urls`` log; the first row of a file is its header.

    A row with a figure that is no number, or with too few or too many fields, ends the job with its text. With
    ``bad_rows="drop"`` such rows are left out; :func:`bad_log_rows` lists them. ``multi_line`` is needed only if values
    contain line breaks; such files cannot be split among tasks.
    """
    if bad_rows not in ("fail", "drop"):
        raise ValueError(f"bad_rows is fail or drop, not {bad_rows}")
    schema, _ = _HEADERS[kind]
    good = F.col(_BAD).isNull()
    if bad_rows == "fail":
        good = F.when(good, True).otherwise(F.raise_error(F.concat(F.lit(f"a bad row in the {kind} log: "), _BAD)).cast("boolean"))
    rows = _parsed(spark, kind, path, multi_line).where(good)
    columns = [F.col(f.name) if f.dataType == T.StringType() else F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*columns).fillna("", [f.name for f in schema.fields if f.dataType == T.StringType()])


def bad_log_rows(spark: SparkSession, kind: str, path: str, multi_line: bool = False) -> DataFrame:
    """``(file, row)``: the rows of a log that :func:`read_log` refuses."""
    return _parsed(spark, kind, path, multi_line).where(F.col(_BAD).isNotNull()).select(F.col("_file").alias("file"), F.col(_BAD).alias("row"))


def _write_csv(df: DataFrame, header: Sequence[str], path: str) -> None:
    df.toDF(*header).write.mode("overwrite").options(**_DIALECT).option("header", True).csv(path)


def write_log(log: DataFrame, kind: str, path: str) -> None:
    schema, header = _HEADERS[kind]
    _write_csv(log.select(*schema.names), header, path)


def write_ranking_stats(table: DataFrame, path: str) -> None:
    """Rows in order of their ``position`` (of their query, if they have none), the averages last.

    The order is that of the part files, and of the rows in each.
    """
    place = "position" if "position" in table.columns else "query"
    numbered = table.sortWithinPartitions("part", place).withColumn("row", F.monotonically_increasing_id())
    rows = numbered.orderBy("part", place, "row").select("query", "n_overlap", "pct_overlap", "rho")
    _write_csv(rows, fixed.RANKING_STATS_HEADER, path)


def read_ranking_stats(spark: SparkSession, path: str) -> DataFrame:
    """``(row, query, n_overlap, pct_overlap, rho)``, ``row`` from 0 in the order of the files."""
    schema = "query string, n_overlap double, pct_overlap double, rho double"
    rows = spark.read.schema(schema).options(**_DIALECT).option("header", True).option("enforceSchema", True).csv(path)
    place = ("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    placed = rows.select("*", F.struct(*place).alias("place"))
    counts = placed.groupBy("place.file_name", "place.file_block_start").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.orderBy("file_name", "file_block_start").rowsBetween(W.unboundedPreceding, -1)  # a row per split
    counts = counts.select(F.col("file_name").alias("f"), F.col("file_block_start").alias("s"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = W.partitionBy("place.file_name", "place.file_block_start").orderBy("place.at")
    return (
        placed.withColumn("nth", F.row_number().over(within) - 1)
        .join(counts, (F.col("place.file_name") == F.col("f")) & (F.col("place.file_block_start") == F.col("s")))
        .select((F.col("before") + F.col("nth")).alias("row"), "query", "n_overlap", "pct_overlap", "rho")
    )


def write_report(lines: DataFrame, path: str) -> None:
    """A report of a few dozen lines as one text file, in order."""
    ordered = lines.orderBy("section_no", "pos").select("value")
    ordered.coalesce(1).write.mode("overwrite").text(path)
