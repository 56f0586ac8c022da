"""Token-id files: documents' ids in ascending order of doc_id, range-coded in blocks, written and read back.

Documents are range-partitioned and sorted by id, then tokenized and cut into pieces of at most ``BLOCK`` ids; a
block holds whole pieces. A file is the committed output of one task: rows of ``part`` (number of the range),
``block``, the ids before it in its range, what pieces it holds, and the coded bytes with their own header and
checksums (:mod:`searchloom.llm.id_coder`). A task that is lost leaves nothing behind, and each block can be
read by itself. Where a range begins is summed over the ranges, one number each.

Defined cases: null or empty text has only the end id; a null doc_id comes first and is kept; rows with equal ids are
in order of their tags; repeated rows are written as often as they occur; an empty table gives no blocks and an
empty result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from searchloom.llm import id_coder
from searchloom.llm.rows import texts_of
from searchloom.llm.vocabulary import WORD_BPE, ChunkIds, read_vocabulary, shared
from searchloom.storage import new_path

BLOCK = 8192
END_ID = 1
SIZE = 49_408  # ids of the vocabulary
PIECES = "struct<doc_id: bigint, nth: int, start: bigint, length: int, total: bigint>"
FILE = f"part int, block int, first long, n_ids int, pieces array<{PIECES}>, coded binary"
PIECE_TYPE = pa.struct(
    [("doc_id", pa.int64()), ("nth", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("total", pa.int64())]
)


def write_ids(docs: DataFrame, path: str, vocabulary: str = WORD_BPE, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents to files below ``path``."""
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    ordered = (
        texts_of(docs, doc_id, text).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tag"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tag")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    end = np.array([END_ID], "<u4").tobytes()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = shared(ChunkIds, sent.value)
        blocks: list[tuple[list, list]] = []  # ids and pieces
        part, first, done, before, row = 0, 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal blocks, done, before
            ids = [np.concatenate(x) for x, _ in blocks]
            sizes = np.array([len(x) for x in ids])
            starts = before + np.cumsum(sizes) - sizes
            columns = [
                pa.array([part] * len(ids), pa.int32()), pa.array(range(done, done + len(ids)), pa.int32()),
                pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()),
                pa.array([p for _, p in blocks], pa.list_(PIECE_TYPE)), pa.array(id_coder.encode(ids, SIZE), pa.binary()),
            ]
            done, before, blocks = done + len(ids), before + int(sizes.sum()), []
            return pa.record_batch(columns, ["part", "block", "first", "n_ids", "pieces", "coded"])

        room = 0
        for batch in batches:
            for part, document, ids in zip(batch.column(0), batch.column(1), ids_of.each(batch.column(2).cast(pa.binary())), strict=True):
                part = part.as_py()
                ids = np.frombuffer(ids + end, "<u4")
                for nth, low in enumerate(range(0, len(ids), BLOCK)):
                    piece = ids[low : low + BLOCK]
                    if len(piece) > room:
                        if len(blocks) == id_coder.SIDE_BY_SIDE:
                            yield flush()
                        blocks.append(([], []))
                        room = BLOCK
                    room -= len(piece)
                    blocks[-1][0].append(piece)
                    blocks[-1][1].append(
                        {"doc_id": document.as_py(), "nth": row, "start": first, "length": len(piece), "total": len(ids)}
                    )
                first += len(ids)
                row += 1
        if blocks:
            yield flush()

    ordered.mapInArrow(code, FILE).write.mode("overwrite").option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of documents from files below ``path``.

    ``doc_id``, ``part`` and ``nth`` (which name the document), ``start`` (ids of all documents before this one),
    ``n_tokens`` of the document, ``place`` of the piece, and its ``ids`` as little-endian unsigned 32-bit numbers.
    """
    files = spark.read.schema(FILE).parquet(path)
    ranges = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ranges = ranges.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("before"))

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), id_coder.SIDE_BY_SIDE):
                rows = batch.slice(low, id_coder.SIDE_BY_SIDE)
                found = id_coder.decode(rows.column(4).to_pylist(), SIZE)
                documents, parts, nths, starts, totals, places, ids = ([] for _ in range(7))
                parts_, firsts, befores = (rows.column(i).to_pylist() for i in (0, 1, 2))
                for k, pieces in enumerate(rows.column(3).to_pylist()):
                    data, at = found[k].astype("<u4").tobytes(), 0
                    for piece in pieces:
                        documents.append(piece["doc_id"])
                        parts.append(parts_[k])
                        nths.append(piece["nth"])
                        starts.append(befores[k] + piece["start"])
                        totals.append(piece["total"])
                        places.append(firsts[k] + at)
                        ids.append(data[4 * at : 4 * (at + piece["length"])])
                        at += piece["length"]
                yield pa.record_batch(
                    [
                        pa.array(documents, pa.int64()), pa.array(parts, pa.int32()), pa.array(nths, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (starts, totals, places)), pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "part", "nth", "start", "n_tokens", "place", "ids"],
                )

    return files.join(F.broadcast(ranges), "part").select("part", "first", "before", "pieces", "coded").mapInArrow(
        open_, "doc_id long, part int, nth int, start long, n_tokens long, place long, ids binary"
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op6: written, read back, and summed up per document."""
    path = new_path(docs.sparkSession, "token-ids")
    write_ids(docs, path)
    pieces = read_ids(docs.sparkSession, path)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, totals = batch.column(6).to_pylist(), batch.column(4).to_pylist()
            whole = [len(x) == 4 * n for x, n in zip(ids, totals, strict=True)]
            checks = pa.array([zlib.crc32(x) if yes else None for x, yes in zip(ids, whole, strict=True)], pa.int64())
            rest = pa.array([None if yes else x for x, yes in zip(ids, whole, strict=True)], pa.binary())
            yield pa.record_batch([*batch.columns[:6], checks, rest], [*names, "place", "ids_crc32", "ids"])

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            checks = batch.column(3).to_pylist()
            for k, parts in enumerate(batch.column(4).to_pylist()):
                if checks[k] is None:
                    checks[k] = reduce(lambda check, x: zlib.crc32(x["ids"], check), parts, 0)
            yield pa.record_batch([*batch.columns[:3], pa.array(checks, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    names = ["doc_id", "part", "nth", "start", "n_tokens"]  # files are decoded once: whole documents go along without their ids
    documents = pieces.mapInArrow(
        begun, "doc_id long, part int, nth int, start long, n_tokens long, place long, ids_crc32 long, ids binary"
    ).groupBy(names).agg(
        F.max("ids_crc32").alias("ids_crc32"),
        F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("place", "ids")))).alias("parts"),
    )
    return documents.select("doc_id", "start", "n_tokens", "ids_crc32", "parts").mapInArrow(
        ended, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
