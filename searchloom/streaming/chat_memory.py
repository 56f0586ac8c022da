"""Conversation memory: the last turns of each conversation, kept as streaming state.

State lives in RocksDB on the executors' disks, with its changes in the checkpoint, so it may outgrow memory and outlives
executors. Updates are appended to a table by the hour; :func:`compact` folds them into a snapshot, after which readers
leave the hours before it alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_OUTPUT = "conv_id bigint, seen bigint, at bigint, memory array<struct<turn: bigint, role: string, text: string>>"
_STATE = "seen bigint, turns array<bigint>, roles array<string>, texts array<string>"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
HOUR = 3_600_000


def memory_updates(turns: DataFrame, n: int, idle_ms: int | None = None) -> DataFrame:
    """Streaming ``(conv_id, seen, at, memory)``: per micro-batch, each touched conversation anew; ``at`` is the batch's time.

    The state holds the ``n`` turns with the highest numbers and how many turns
    were seen. Turns may come in any order, and a batch is folded in piece by
    piece, so memory stays bounded for any conversation. One without turns for ``idle_ms`` is over: its state goes, and if
    it goes on after all, its memory begins anew. Without ``idle_ms`` none is ever over.
    """

    def remember(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, kept = 0, []
        if state.exists:
            seen, *columns = state.get
            kept = list(zip(*columns))
        for batch in batches:
            seen += len(batch)
            last = batch.nlargest(n, "turn")
            kept = sorted([*kept, *zip(last["turn"], last["role"], last["text"])], key=lambda t: t[0])[-n:]
        state.update((seen, *([int(t[0]) for t in kept], [t[1] for t in kept], [t[2] for t in kept])))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        memory = [{"turn": int(turn), "role": role, "text": text} for turn, role, text in kept]
        yield pd.DataFrame({"conv_id": [key[0]], "seen": [seen], "at": [state.getCurrentProcessingTimeMs()], "memory": [memory]})

    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return (
        turns.select("conv_id", "turn", "role", "text").groupBy("conv_id")
        .applyInPandasWithState(remember, _OUTPUT, _STATE, "append", timeout)
    )


def start_memory(
    turns: DataFrame, n: int, path: str, checkpoint: str, available_now: bool = False, idle_ms: int | None = None
) -> StreamingQuery:
    """Append the updates to a Parquet table (exactly once per micro-batch), by hour; state is kept in RocksDB."""
    spark = turns.sparkSession
    updates = memory_updates(turns, n, idle_ms).withColumn("hour", F.expr(f"at div {HOUR}"))
    writer = (
        updates.writeStream.outputMode("append").partitionBy("hour")
        .format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    settings = {_PROVIDER: _ROCKSDB}
    if available_now:
        settings[_NO_DATA] = "false"  # a run that is to end must not wait for conversations to become idle
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():  # a query keeps the settings that it began with
        spark.conf.set(name, value)
    try:
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def current_memory(updates: DataFrame) -> DataFrame:
    """``(conv_id, seen, at, memory)`` after the latest update of each conversation."""
    latest = F.max_by(F.struct("seen", "at", "memory"), F.struct("at", "seen")).alias("latest")
    return updates.groupBy("conv_id").agg(latest).select("conv_id", "latest.*")


def compact(spark: SparkSession, path: str, snapshots: str, since: int | None = None) -> int | None:
    """Fold the updates at ``path`` into a snapshot below ``snapshots``; its hour, to be given as ``since`` from then on.

    ``since`` is the hour of the snapshot before. Updates of the snapshot's own hour may still come, so readers take that
    hour again. None if there are no updates at all.
    """
    hour = spark.read.parquet(path).agg(F.max("hour")).first()[0]  # from the folders' names and footers
    if hour is None:
        return since
    latest_memory(spark, path, snapshots, since).write.mode("overwrite").parquet(f"{snapshots}/through={hour}-after={since}")
    return hour


def latest_memory(spark: SparkSession, path: str, snapshots: str | None = None, since: int | None = None) -> DataFrame:
    """:func:`current_memory` from the newest snapshot, the one of hour ``since``, and the updates from then on."""
    columns = ["conv_id", "seen", "at", "memory"]
    updates = spark.read.parquet(path)
    if since is None:
        return current_memory(updates.select(columns))
    folded = spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{snapshots}/through={since}-after=*")
    return current_memory(updates.where(F.col("hour") >= since).select(columns).unionByName(folded.select(columns)))
