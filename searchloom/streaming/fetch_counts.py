"""Running counts of fetch outcomes over logs that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from searchloom.operators.links import outcome


def running_counts(fetches: DataFrame) -> DataFrame:
    """Streaming ``(outcome, n)``; the state is one row per outcome, however many fetches."""
    return fetches.groupBy(outcome(F.col("status")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n")
    )


def start_running_counts(
    fetches: DataFrame, name: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the complete counts (a handful of rows) in the in-memory table ``name``."""
    writer = (
        running_counts(fetches).writeStream.outputMode("complete")
        .format("memory").queryName(name).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
