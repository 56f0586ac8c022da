"""The first rows of a global order, without sending the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from searchloom.storage import written

SMALL_LIMIT = 100_000


def first_rows(df: DataFrame, order: list[str], limit: int, small: int = SMALL_LIMIT) -> DataFrame:
    """Exactly the first ``limit`` rows of ``df`` in ``order`` (which must be a total order).

    Small limits are a top-k. Beyond that the rows are written in ranges; whole
    ranges are kept by their counts, and only the range in which the limit falls
    is numbered.
    """
    if limit <= small:
        return df.orderBy(*order).limit(limit)
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    table = written(ranged, "ordered")
    kept, boundary, left = 0, None, limit
    for row in table.groupBy("_range").count().orderBy("_range").collect():  # one row per range
        if row["count"] > left:
            boundary = row["_range"]
            break
        kept, left = row["_range"] + 1, left - row["count"]
    whole = table.where(F.col("_range") < kept)
    if boundary is None or left == 0:
        return whole.drop("_range")
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    part = table.where(F.col("_range") == boundary).withColumn("_place", place)
    return whole.unionByName(part.where(F.col("_place") <= left).drop("_place")).drop("_range")


def numbered(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """``df`` with ``name``: each row's place, from 0, in a global ``order`` (which must be a total order).

    Rows are written in ranges and numbered inside them; a range begins at the sum of the counts before it.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    table, offset, offsets = written(ranged, "ordered"), 0, []
    for row in table.groupBy("_range").count().orderBy("_range").collect():  # one row per range
        offsets.append((row["_range"], offset))
        offset += row["count"]
    begins = df.sparkSession.createDataFrame(offsets, "_range int, _begin long")
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    placed = table.withColumn("_place", place).join(F.broadcast(begins), "_range")
    return placed.withColumn(name, F.col("_begin") + F.col("_place")).drop("_range", "_place", "_begin")
