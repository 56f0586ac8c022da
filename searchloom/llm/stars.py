"""Links tested star by star: a hub's payload is sent once per ``PART`` of its partners, each partner's once per pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.shingles import shingle_sets
from searchloom.storage import written

PART = 4096
ROWS_AT_ONCE = 256
Test = Callable[[int, bytes, pa.Array, np.ndarray], np.ndarray]


def tested(pairs: DataFrame, payloads: DataFrame, test: Callable[[], Test]) -> DataFrame:
    """The pairs ``a``, ``b`` (``a`` is the hub) that pass; ``pairs`` is a written table, ``payloads``: ``node``, ``n``, ``payload``.

    ``test`` makes a function of the hub's ``n`` and payload and of its partners' payloads and ``n``. Partners
    of one hub are dealt to as many runs as there are ``PART`` of them, so a hub that a third of all rows link with is
    no task of its own.
    """
    runs = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("runs"))
    partners = pairs.join(runs, "a").withColumn("run", F.pmod(F.xxhash64("b"), F.col("runs")).cast("int"))
    own = payloads.select(F.col("node").alias("b"), "n", "payload")
    rows = partners.join(own.hint("merge"), "b").select("a", "run", F.lit(1).alias("kind"), "b", "n", "payload")
    hubs = runs.join(payloads.withColumnRenamed("node", "a").hint("merge"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("kind"), F.col("a").alias("b"), "n", "payload"
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, hub, held = test(), None, (0, b"")
        for batch in batches:
            a, kind, n = (batch.column(i).to_numpy() for i in (0, 2, 4))
            cuts = [*np.flatnonzero(kind == 0).tolist(), len(batch)]
            edges = [0, *cuts] if cuts[0] else cuts
            for low, high in zip(edges, edges[1:], strict=False):
                if kind[low] == 0:
                    hub, held = int(a[low]), (int(n[low]), batch.column(5)[low].as_py())
                    low += 1
                while low < high:
                    end = min(high, low + ROWS_AT_ONCE)
                    part = batch.slice(low, end - low)
                    keep = pa.array(passes(hub, *held, part.column(5), n[low:end]), pa.bool_())
                    yield pa.record_batch([part.column(0), part.column(3)], ["a", "b"]).filter(keep)
                    low = end

    ordered = rows.unionByName(hubs).repartition("a", "run").sortWithinPartitions("a", "run", "kind")
    return ordered.mapInArrow(stream, "a long, b long")


def by_members(k: int, percent: int) -> Callable[[], Test]:
    """Exact: the payloads are deflated texts, linked by their sets of ``k``-word shingles."""

    def make() -> Test:
        unpack = zstandard.ZstdDecompressor().decompress
        last: list = [None, None]

        def linked(hub: int, n: int, payload: bytes, others: pa.Array, sizes: np.ndarray) -> np.ndarray:
            if last[0] != hub:
                last[:] = hub, next(shingle_sets(pa.array([unpack(payload).decode()]), k))
            mine = last[1]
            sets = list(shingle_sets(pa.array([unpack(x.as_py()).decode() for x in others], pa.string()), k))
            shared = np.array([len(np.intersect1d(mine, x, assume_unique=True)) for x in sets], np.int64)
            total = np.array([len(x) for x in sets], np.int64) + len(mine)
            return 100 * shared >= percent * (total - shared)

        return linked

    return make


def bodies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Deflated texts of the rows ``id``, ``tag`` of ``wanted``, as payloads of its ``node``; ``texts``: ``id``, ``tag``, ``text``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [deflate(x.as_py()) for x in batch.column(2).cast(pa.binary())]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["id", "tag", "payload"])

    deflated = texts.select("id", "tag", "text").mapInArrow(pack, "id long, tag long, payload binary")
    found = wanted.join(deflated.hint("merge"), ["id", "tag"])
    return written(found.groupBy("node").agg(F.first("n").alias("n"), F.first("payload").alias("payload")), "bodies")
