import time

from pyspark.sql import functions as F

from searchloom.sources import csv_logs
from searchloom.streaming import chat_memory, fetch_counts

TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_running_counts_over_arriving_logs(spark, tmp_path):
    logs, state = tmp_path / "logs", str(tmp_path / "state")

    def arrive(*statuses):
        rows = [("u", s) for s in statuses]
        spark.createDataFrame(rows, csv_logs.FETCH_LOG).coalesce(1).write.mode("append").parquet(str(logs))

    def counts():
        stream = spark.readStream.schema(csv_logs.FETCH_LOG).parquet(str(logs))
        fetch_counts.start_running_counts(stream, "arriving_counts", state, available_now=True).awaitTermination()
        return {r.outcome: r.n for r in spark.table("arriving_counts").collect()}

    arrive("200", "200", "301", "FAILED")
    assert counts() == {"success": 2, "redirect": 1, "failed": 1}
    arrive("200", "404")
    assert counts() == {"success": 3, "redirect": 1, "failed": 1, "error": 1}


def test_memory_keeps_the_last_turns_in_any_order(spark, tmp_path):
    turns, out, state = (str(tmp_path / name) for name in ("turns", "out", "state"))

    def arrive(*rows):
        spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(turns)

    def memory():
        stream = spark.readStream.schema(TURNS).parquet(turns)
        chat_memory.start_memory(stream, 3, out, state, available_now=True).awaitTermination()
        current = chat_memory.current_memory(spark.read.parquet(out))
        return {r.conv_id: (r.seen, [m.turn for m in r.memory]) for r in current.collect()}

    arrive((1, 3, "user", "d"), (1, 0, "user", "a"), (2, 0, "user", "x"))
    assert memory() == {1: (2, [0, 3]), 2: (1, [0])}
    arrive((1, 2, "user", "c"), (1, 1, "assistant", "b"), (1, 4, "user", "e"))
    assert memory() == {1: (5, [2, 3, 4]), 2: (1, [0])}
    updates = spark.read.parquet(out).where(F.col("conv_id") == 2).count()
    assert updates == 1  # untouched conversations write nothing


def test_memory_outlives_a_restart_and_is_compacted(spark, tmp_path):
    turns, out, state, snapshots = (str(tmp_path / name) for name in ("turns", "out", "state", "snapshots"))

    def arrive(*rows):
        spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(turns)

    def run():
        chat_memory.start_memory(spark.readStream.schema(TURNS).parquet(turns), 2, out, state, available_now=True).awaitTermination()

    def memory(frame):
        return {r.conv_id: (r.seen, [m.turn for m in r.memory]) for r in frame.collect()}

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    arrive((1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "x"))
    run()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider
    assert any(p.suffix == ".zip" or p.suffix == ".changelog" for p in (tmp_path / "state" / "state").rglob("*"))  # RocksDB's files
    hour = chat_memory.compact(spark, out, snapshots)
    assert memory(chat_memory.latest_memory(spark, out, snapshots, hour)) == {1: (2, [0, 1]), 2: (1, [0])}
    arrive((1, 2, "user", "c"), (3, 5, "user", "y"))
    run()  # a new query on the old checkpoint
    want = {1: (3, [1, 2]), 2: (1, [0]), 3: (1, [5])}
    assert memory(chat_memory.latest_memory(spark, out)) == want
    assert memory(chat_memory.latest_memory(spark, out, snapshots, hour)) == want
    later = chat_memory.compact(spark, out, snapshots, hour)
    assert later >= hour and memory(chat_memory.latest_memory(spark, out, snapshots, later)) == want


def test_an_idle_conversation_begins_anew(spark, tmp_path):
    turns, out, state = (str(tmp_path / name) for name in ("turns", "out", "state"))

    def arrive(*rows):
        spark.createDataFrame(rows, TURNS).coalesce(1).write.mode("append").parquet(turns)

    def run():
        stream = spark.readStream.schema(TURNS).parquet(turns)
        chat_memory.start_memory(stream, 3, out, state, available_now=True, idle_ms=1000).awaitTermination()

    arrive((1, 0, "user", "a"), (2, 0, "user", "x"))
    run()
    time.sleep(1.5)
    arrive((2, 1, "user", "y"))
    run()  # ends conversation 1, and 2 goes on as its turn comes in the same batch
    arrive((1, 1, "user", "b"))
    run()
    current = {r.conv_id: (r.seen, [m.turn for m in r.memory]) for r in chat_memory.current_memory(spark.read.parquet(out)).collect()}
    assert current == {1: (1, [1]), 2: (2, [0, 1])}
