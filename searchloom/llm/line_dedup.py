"""Line dedup: range-partitioned line hashes, sorted by document and position, decided in one stream.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Each document
sends one row per different key, with the places of the key's lines. The rows are range-partitioned by key and
document, sorted within the partition, and read as a stream: a run of one key is a count of documents, and
the rows named like its first one hold the key's first occurrence. A run that touches an end of its partition may go on in the
next one; those keys alone are counted by a grouping that combines before its shuffle. So a key that a third of
all documents share is spread over as many partitions as its rows need.

Only places travel back: per document one bitmap of the lines that stay, deflated. Texts are joined with
the bitmaps once.

Defined cases: null or empty text is one empty line; keys shorter than ``min_chars`` code points always stay;
repeated rows are documents of their own, and if they are the first with a key, each of them keeps it; a null id is an id like any other; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.rows import keys_of, texts_of, unused, with_text
from searchloom.storage import written

WHITE = b" \t\n\x0b\x0c\r"
ROW = "key long, key2 long, id long, tag long, lines array<int>"


def _line_keys(min_chars: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, keys2, rows, places, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column(2)):
                seen: dict[bytes, list[int]] = {}
                for place, line in enumerate(text.as_py().encode().split(b"\n")):
                    key = line.strip(WHITE).lower()  # bytes.lower() changes A-Z only
                    if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                        seen.setdefault(key, []).append(place)
                for key, lines in seen.items():
                    digest = xxhash.xxh3_128_intdigest(key)
                    keys.append(digest & 0xFFFFFFFFFFFFFFFF)
                    keys2.append(digest >> 64)
                    rows.append(row)
                    places += lines
                    ends.append(len(places))
            where = pa.array(rows, pa.int32())
            yield pa.record_batch(
                [
                    pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.array(keys2, np.uint64).view(np.int64)),
                    batch.column(0).take(where), batch.column(1).take(where),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32())),
                ],
                ["key", "key2", "id", "tag", "lines"],
            )

    return find


def _stream(min_docs: int):
    """Decide the runs of a sorted partition; ``n`` is null for the runs at its ends."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the run that is still open
        decided = False  # the open run has begun inside this partition

        def close(parts: list[pa.RecordBatch], inside: bool) -> Iterator[pa.RecordBatch]:
            n = sum(len(p) for p in parts)
            if inside and n < min_docs:
                return
            head_id, head_tag = (parts[0].column(i)[0].as_py() for i in (2, 3))
            for part in parts:
                first = (part.column(2).to_numpy() == head_id) & (part.column(3).to_numpy() == head_tag)
                yield pa.record_batch(
                    [*part.columns, pa.array([n if inside else None] * len(part), pa.int64()), pa.array(first)],
                    [*part.schema.names, "n", "first"],
                )

        for batch in batches:
            if not len(batch):
                continue
            a, b = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            edges = [0, *cuts.tolist(), len(batch)]
            if held and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != (a[0], b[0]):
                yield from close(held, decided)
                held, decided = [], True
            lengths = np.diff(edges)
            for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
                last = k == len(lengths) - 1
                if last or (k == 0 and held):
                    held.append(batch.slice(low, high - low))
                    if not last:
                        yield from close(held, decided)
                        held, decided = [], True
                elif not decided:
                    yield from close([batch.slice(low, high - low)], False)
                    decided = True
                elif lengths[k] >= min_docs:
                    yield from close([batch.slice(low, high - low)], True)
        if held:
            yield from close(held, False)

    return decide


def dropped_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row with a line to drop: ``id``, ``tag``, ``gone`` (sorted line numbers).

    A line goes if its key is in ``min_docs`` documents or more; with ``keep_first`` the first such document
    (by id) keeps its first line with the key.
    """
    texts = texts_of(docs, doc_id, text)
    lines = texts.select("id", "tag", "text").mapInArrow(_line_keys(min_chars), ROW)
    lines = written(lines, "line-keys")  # the range partitioner reads it twice
    runs = (
        lines.repartitionByRange("key", "key2", "id", "tag").sortWithinPartitions("key", "key2", "id", "tag")
        .mapInArrow(_stream(min_docs), ROW + ", n long, first boolean")
    )
    runs = written(runs, "line-runs")
    inside, ends = runs.where("n IS NOT NULL"), runs.where("n IS NULL")
    counted = (
        ends.groupBy("key", "key2").agg(F.count("*").alias("total"), F.min(F.struct("id", "tag")).alias("head"))
        .where(F.col("total") >= min_docs)
    )
    at_ends = ends.join(counted, ["key", "key2"]).withColumn("first", F.struct("id", "tag") == F.col("head"))
    columns = ["id", "tag", "lines", "first"]
    found = inside.select(columns).unionByName(at_ends.select(columns))
    lines_gone = F.col("lines")
    if keep_first:
        lines_gone = F.when(F.col("first"), F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(lines_gone)
    return found.groupBy("id", "tag").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(lines_gone)))).alias("gone"))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps, counts, gone = [], [], []
        for text, lost in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            keep = np.ones(text.count("\n") + 1, bool)
            if lost:
                keep[lost] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            counts.append(len(keep))
            gone.append(len(keep) - int(keep.sum()))
        yield pa.record_batch(
            [*batch.columns[:4], pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(maps, pa.binary())],
            ["id", "tag", "doc_id", "text", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: ``doc_id``, its ``text``, ``n_lines``, ``n_dropped`` and ``keep``, a deflated bitmap with one bit per line.

    ``id`` and ``tag`` name the row as in :func:`searchloom.llm.rows.texts_of`.
    """
    gone = written(dropped_lines(docs, doc_id=doc_id, text=text, **options), "lines-gone").hint("merge")  # grows with the documents
    return texts_of(docs, doc_id, text).join(gone, ["id", "tag"], "left").select("id", "tag", "doc_id", "text", "gone").mapInArrow(
        _bitmaps, "id long, tag long, doc_id long, text string, n_lines long, n_dropped long, keep binary"
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, dropped, keep in zip(*(batch.column(i).to_pylist() for i in (3, 5, 6)), strict=True):
            if dropped:
                lines = text.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                text = "\n".join(line for line, bit in zip(lines, bits.tolist(), strict=True) if bit)
            kept.append(text)
        yield pa.record_batch(
            [*batch.columns[:3], pa.array(kept, pa.string()), *batch.columns[4:6]],
            ["id", "tag", "doc_id", "kept", "n_lines", "n_dropped"],
        )


def without_lines(bitmaps: DataFrame) -> DataFrame:
    """Apply keep bitmaps: ``id``, ``tag``, ``doc_id``, ``kept`` (the lines that stay), ``n_lines``, ``n_dropped``."""
    return bitmaps.mapInArrow(_apply, "id long, tag long, doc_id long, kept string, n_lines long, n_dropped long")


def _cut(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the lines of these numbers, by a bitmap of the lines that stay."""
    kept = []
    for text, numbers in zip(texts, gone, strict=True):
        if numbers is not None:
            lines = text.split("\n")
            keep = np.ones(len(lines), bool)
            keep[numbers] = False
            text = "\n".join(itertools.compress(lines, keep))
        kept.append(text)
    return pd.Series(kept, dtype=object)


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines to drop; a row that loses all its words goes. ``n_chars`` follows the text."""
    id_, tag, gone = unused(docs, "id", "tag", "gone")
    lost = written(dropped_lines(docs, doc_id=doc_id, text=text, **options), "lines-gone").where(F.size("gone") > 0)
    lost = lost.select(F.col("id").alias(id_), F.col("tag").alias(tag), F.col("gone").alias(gone))
    keys = docs.withColumns(dict(zip((id_, tag), keys_of(docs, doc_id, text), strict=True)))
    joined = keys.join(lost.hint("merge"), [id_, tag], "left")
    rest = joined.withColumn(text, F.pandas_udf(_cut, "string")(F.col(f"`{text}`"), F.col(gone)))
    rest = rest.where(F.col(gone).isNull() | F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"))
    return rest.select(*(f"`{c}`" for c in docs.columns)).select(with_text(docs, F.col(f"`{text}`"), text))


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op7."""
    return without_lines(keep_bitmaps(docs)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
