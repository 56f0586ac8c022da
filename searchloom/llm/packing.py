"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Documents are tokenized once. One longer than a window is cut into whole windows, which are full sequences, and a
rest. The rests are dealt by hash into groups of about ``GROUP`` (so no source and no group of copies meets in
one task) and each group is packed into ``k`` windows: every rest starts as a partial partition of its own, with one
filled window and ``k - 1`` empty ones; the two partial partitions with the largest imbalance are merged again and
again, the fullest window of one with the emptiest of the other, until one is left, whose windows are nearly equal.
``k`` begins at the least count that could hold the group and rises whenever a window exceeds the capacity.
Only places are packed; on request (``with_ids``) each piece carries its ids (``ids``, four little-endian bytes each)
through the packing, so that sequences can be written from the result.

Defined cases: null or empty text has only the end id; repeated rows are packed as often as they occur; a null id is
kept as null; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.vocabulary import WORD_BPE, ChunkIds, read_vocabulary, shared
from searchloom.storage import written

WINDOW = 4096
END_ID = 2
GROUP = 512
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of each size, by Karmarkar-Karp differencing into ``k`` windows."""
    n = len(sizes)
    children: list[tuple[int, int]] = []  # of nodes n, n + 1, ...; below n: single sizes
    heap = []
    for item in np.argsort(-sizes, kind="stable").tolist():
        loads, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        loads[-1], nodes[-1] = sizes[item], item
        heap.append((-int(sizes[item]) if k > 1 else 0, item, loads, nodes))
    heapq.heapify(heap)
    ticket = n
    while len(heap) > 1:
        _, _, loads_a, nodes_a = heapq.heappop(heap)
        _, _, loads_b, nodes_b = heapq.heappop(heap)
        loads, other = loads_a + loads_b[::-1], nodes_b[::-1]
        nodes = np.where(nodes_a < 0, other, nodes_a)
        both = np.flatnonzero((nodes_a >= 0) & (other >= 0))
        nodes[both] = n + len(children) + np.arange(len(both))
        children += zip(nodes_a[both].tolist(), other[both].tolist(), strict=True)
        order = np.argsort(loads, kind="stable")
        loads, nodes = loads[order], nodes[order]
        heapq.heappush(heap, (int(loads[0] - loads[-1]), ticket, loads, nodes))
        ticket += 1
    window = np.zeros(n, np.int64)
    for place, node in enumerate(heap[0][3].tolist() if heap else []):
        below = [node] if node >= 0 else []
        while below:
            node = below.pop()
            if node < n:
                window[node] = place
            else:
                below += children[node - n]
    return window


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size (none over ``capacity``), with as few windows as differencing can do with."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        over = int(np.bincount(window, sizes, minlength=k).max(initial=0)) - capacity
        if over <= 0:
            return window
        k += max(1, k * over // (8 * capacity))


def pieces(
    docs: DataFrame, path: str = WORD_BPE, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each document's ids, with the end id, cut into whole windows and a rest; one row per piece."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = shared(ChunkIds, vocabulary.value)
        for batch in batches:
            rows, starts, lengths, checks, totals, bodies = [], [], [], [], [], []
            for row, ids in enumerate(ids_of.each(batch.column(1).cast(pa.binary()))):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                for start in range(0, n, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(part) // 4)
                    checks.append(zlib.crc32(part))
                    totals.append(n)
                    if with_ids:
                        bodies.append(bytes(part))
            columns = [
                batch.column(0).take(pa.array(rows, pa.int32())),
                *(pa.array(c, pa.int64()) for c in (starts, lengths, checks, totals)),
                *([pa.array(bodies, pa.binary())] if with_ids else []),
            ]
            yield pa.record_batch(columns, names)

    schema = PIECE + ", ids binary" * with_ids
    names = [column.split()[0] for column in schema.split(", ")]
    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(cut, schema)


def packed(
    docs: DataFrame, path: str = WORD_BPE, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False, **columns: str
) -> DataFrame:
    """Pieces with their place: ``sequence_id`` and ``offset`` there, gapless from 0; ``ids`` as in :func:`pieces`."""
    table = written(pieces(docs, path, window, end_id, with_ids, **columns), "pieces")
    groups = max(1, -(-table.count() // GROUP))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], ignore_index=True)
        sizes = group["length"].to_numpy()
        full = int((sizes == window).sum())
        sequence = np.arange(len(group), dtype=np.int64)
        sequence[full:] = full + pack(sizes[full:], window)
        group["sequence_id"] = (group["dealt"].to_numpy().astype(np.int64) << 24) + sequence
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group.drop(columns="dealt")

    dealt = table.withColumn("dealt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("dealt").applyInPandas(
        place, PIECE + ", ids binary" * with_ids + ", sequence_id long, offset long"
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op4."""
    return packed(docs)
