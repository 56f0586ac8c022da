"""Shared storage for intermediate tables.

Intermediate results that several jobs read (a link table, the levels of a reach
run) are written as Parquet into the folder the cluster names in
``spark.checkpoint.dir``. They outlive any executor, and reading them back gives
Catalyst real sizes, so it can choose join strategies from facts.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20  # or one row


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; in local mode a temporary one if none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="searchloom-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/searchloom/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The jobs inside run with this setting of the session."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """The jobs inside remove their shuffle files when they end; else those stay until the driver collects its garbage."""
    return setting(spark, CLEANUP, "true")


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back from it; the shuffles of the write leave no files.

    Python steps get their rows in batches of ``BATCH_BYTES``: by number alone, 10,000 texts would be one batch.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with shuffles_removed(spark), setting(spark, BATCH, str(BATCH_BYTES)):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_out(table: DataFrame) -> DataFrame:
    """Deal the rows of a small stored table out to all cores, for heavy work per row.

    A table that is read in at least as many splits as there are cores (any large
    one) is returned as it is, without a shuffle.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


class Placed:
    """A table in the shared folder, bucketed by a column, so that joins and groupings on it need no shuffle of it.

    There are as many buckets as shuffle partitions, which the other side of a join then has too. ``by`` divides
    the table into folders; :meth:`append` adds rows. The session's catalog knows the table, the files outlive it.
    """

    def __init__(self, rows: DataFrame, key: str, name: str, by: str | None = None):
        self.spark, self.key, self.by = rows.sparkSession, key, by
        self.path = new_path(self.spark, name)
        self.name = f"searchloom_{name}_{uuid.uuid4().hex}".replace("-", "_")
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = rows.schema
        self.append(rows.repartition(self.buckets, key))

    def append(self, rows: DataFrame) -> None:
        """Add rows, best those that a join or grouping on the key has just dealt out: each task then writes few buckets."""
        writer = rows.write.mode("append").option("path", self.path)
        writer = writer.bucketBy(self.buckets, self.key).sortBy(self.key)
        (writer.partitionBy(self.by) if self.by else writer).saveAsTable(self.name)

    def read(self) -> DataFrame:
        """The table with its buckets."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def files(self) -> DataFrame:
        """The rows as plain files; the table leaves the catalog."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return self.spark.read.schema(self.schema).parquet(self.path)
