"""Records with four text fields as JSON arrays, and the table they are loaded into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchloom.functions.models import TermVectors, Vectorizer, with_vectors

# Field names in the file, and in the table.
FIELDS = {
    "Title": "title", "Artist": "artist",
    "Subgenre": "subgenre", "Characteristics": "characteristics",
}
RECORDS_PER_ARRAY = 10_000
_FILE_SCHEMA = ", ".join(f"{name} string" for name in FIELDS)


def read_records(spark: SparkSession, path: str, one_array_per_file: bool = False) -> DataFrame:
    """Records from one JSON array (or object) per line, or from indented one-array files."""
    return spark.read.schema(_FILE_SCHEMA).option("multiLine", one_array_per_file).json(path)


def write_records(records: DataFrame, path: str, records_per_array: int = RECORDS_PER_ARRAY) -> None:
    """Write records as JSON arrays, one per line.

    Arrays are cut by row number within a task, not by value, so copies of one
    record cannot gather in one array. The rows of a task are sorted first: a task
    that runs again gives the same numbers.
    """
    array = F.floor(F.monotonically_increasing_id() / F.lit(records_per_array))
    (
        records.sortWithinPartitions(*FIELDS)
        .withColumn("array", array)
        .groupBy("array")
        .agg(F.to_json(F.collect_list(F.struct(*FIELDS))).alias("value"))
        .select("value").write.mode("overwrite").text(path)
    )


def renamed(records: DataFrame) -> DataFrame:
    return records.select(*FIELDS).withColumnsRenamed(FIELDS)


def replace_table(records: DataFrame, path: str, vectorizer: Vectorizer | TermVectors) -> DataFrame:
    """Replace the table at ``path`` by the records with a vector each; return it read back.

    Texts reach a callable in Arrow batches
    (``spark.sql.execution.arrow.maxRecordsPerBatch``).
    """
    fields = list(FIELDS.values())
    table = with_vectors(renamed(records), F.concat_ws(" ", *fields), vectorizer)
    table.write.mode("overwrite").parquet(path)
    return records.sparkSession.read.schema(table.schema).parquet(path)
