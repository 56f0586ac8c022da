"""Substring dedup in two fixed levels and a window test, in place of level-wise doubling until no candidate survives.

One length, one extension, one test: the length isn't doubled in a loop. Steps, for windows of ``m`` words (35):

1. ``ceil(m / 2)`` words, at content-selected positions. Every window of ``m`` words holds one of them, at
   the same place in all its copies. What is found once is dropped.
2. Survivors are extended to about twice ``m``: as far to both sides as a window of ``m`` words that holds them can
   reach. Where that repeats, all such windows repeat: the candidate is settled, and one of its copies
   stands for the others from here on.
3. What isn't settled, and one of each settled group: each window of ``m`` words that holds the candidate.

Then no candidate is left. Each level counts hashes, combined before the shuffle, and joins the repeated ones
back to their positions, a join whose hot keys Spark splits. Texts are shuffled once and read three times.
Hashes of levels 2 and 3 have 96 bits.

Defined cases: null or empty text has no words; texts of under ``m`` words lose nothing; repeated rows are
copies of each other and lose what they share; rows with a null id are documents like any other; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm import words as W
from searchloom.llm.rows import anchors, covered, lists, range_hashes, texts_of
from searchloom.storage import written

KEY = ["id", "tag"]


def _second(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _reach(words: W.Words, at: np.ndarray, text: np.ndarray, k: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of what windows of ``m`` words around the candidates can cover."""
    return np.maximum(words.first[text], at + k - m), np.minimum(words.first[text + 1], at + m)


def _positions(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sort_array(F.collect_set("at")).alias(name))


def repeated_windows(docs: DataFrame, m: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts with what repeats in them.

    Columns ``id``, ``tag``, ``doc_id``, ``text``, ``starts`` (word indices at which a window of ``m`` words
    begins that begins elsewhere too) and ``settled`` (indices of candidates around which all windows do).
    """
    k = (m + 1) // 2
    texts = texts_of(docs, doc_id, text)
    found = anchors(texts, k, m)
    repeated = found.groupBy("gram").count().where("count > 1").select("gram")
    survivors = written(_positions(found.join(repeated, "gram", "left_semi"), "ats"), "substring-survivors")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, rows = lists(batch.column(3))
            for row, part in W.pieces(batch.column(2)):
                words = W.words_of(part)
                mine = slice(*np.searchsorted(rows, [row, row + len(part)]))
                document = rows[mine] - row
                at = values[mine] + words.first[document]
                low, high = _reach(words, at, document, k, m)
                hashes, others = W.word_hashes(words), W.word_hashes(words, seed=1)
                sides = W.mix(((at - low) * 65536 + (high - at)).astype(np.uint64))
                where = pa.array(rows[mine])
                yield pa.record_batch(
                    [
                        pa.array(W.signed(range_hashes(hashes, low, high) ^ sides)),
                        pa.array(_second(range_hashes(others, low, high, 1) ^ sides)),
                        batch.column(0).take(where), batch.column(1).take(where), pa.array(values[mine].astype(np.int32)),
                    ],
                    ["wide", "wide2", "id", "tag", "at"],
                )

    wide = (
        texts.join(survivors, KEY).select(*KEY, "text", "ats")
        .mapInArrow(extend, "wide long, wide2 int, id long, tag long, at int")
    )
    wide = written(wide, "substring-wide")
    groups = (
        wide.groupBy("wide", "wide2").agg(F.count("*").alias("n"), F.min(F.struct("id", "tag", "at")).alias("head"))
        .where("n > 1")
    )
    marked = wide.join(groups, ["wide", "wide2"], "left").select(
        *KEY, "at", F.col("n").isNotNull().alias("settled"),
        (F.col("n").isNull() | (F.struct("id", "tag", "at") == F.col("head"))).alias("open"),
    )
    marked = written(
        marked.groupBy(*KEY).agg(
            F.sort_array(F.collect_set(F.when(F.col("open"), F.col("at")))).alias("open"),
            F.sort_array(F.collect_set(F.when(F.col("settled"), F.col("at")))).alias("settled"),
        ),
        "substring-marked",
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, rows = lists(batch.column(3))
            for row, part in W.pieces(batch.column(2)):
                words = W.words_of(part)
                mine = slice(*np.searchsorted(rows, [row, row + len(part)]))
                document = rows[mine] - row
                low, high = _reach(words, values[mine] + words.first[document], document, k, m)
                start = np.flatnonzero(covered(len(words.start) + 1, low, np.maximum(low, high - m + 1)))
                hashes = W.window_hashes(W.word_hashes(words), m)
                others = W.window_hashes(W.word_hashes(words, seed=1), m, 1)
                text = words.text[start]
                where = pa.array(text + row)
                yield pa.record_batch(
                    [
                        pa.array(W.signed(hashes[start])), pa.array(_second(others[start])),
                        batch.column(0).take(where), batch.column(1).take(where),
                        pa.array((start - words.first[text]).astype(np.int32)),
                    ],
                    ["window", "window2", "id", "tag", "at"],
                )

    exact = (
        texts.join(marked, KEY).select(*KEY, "text", "open").where(F.size("open") > 0)
        .mapInArrow(windows, "window long, window2 int, id long, tag long, at int")
    )
    exact = written(exact, "substring-windows")
    twice = exact.groupBy("window", "window2").count().where("count > 1").select("window", "window2")
    starts = _positions(exact.join(twice, ["window", "window2"], "left_semi"), "starts")
    spans = starts.join(marked.select(*KEY, "settled"), KEY, "full")
    return texts.join(written(spans, "substring-spans"), KEY, "left")


def remove_repeated(docs: DataFrame, m: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space) and
    ``spans`` (first word and end of each removed run)."""
    k = (m + 1) // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept, spans = [], [], [], []
            for value, starts, settled in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words = value.encode().split()
                n = len(words)
                counts.append(n)
                if not starts and not settled:
                    removed.append(0)
                    spans.append([])
                    kept.append(b" ".join(words).decode())
                    continue
                first, around = np.array(starts or [], np.int64), np.array(settled or [], np.int64)
                gone = covered(
                    n, np.concatenate((first, np.maximum(0, around + k - m))),
                    np.concatenate((first + m, np.minimum(n, around + m))),
                )
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode())
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
            yield pa.record_batch(
                [
                    batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "spans"],
            )

    return repeated_windows(docs, m, doc_id, text).select("doc_id", "text", "starts", "settled").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: int, end: int>>"
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op1: what is left of each document, as a checksum."""
    return remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


