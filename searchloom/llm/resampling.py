"""Importance resampling towards a target: weights scored from an array, then a distributed quickselect.

A text's features are its words and pairs of neighbouring words, hashed into buckets (crc32 modulo ``BUCKETS``). Bucket
counts over all documents and over all target texts give each bucket a gain; a document's weight is the floored mean of
its features' gains, plus a Gumbel noise that depends on its id alone, so the largest scores are a sample without
replacement in proportion to the weights.

1. Counts: each task adds up its buckets in one array; tasks send ``BUCKETS`` numbers each.
2. Scores: the gains (one array of ``BUCKETS`` numbers, whatever the input) go to the tasks. Features are hashed with
   NumPy over all words of a batch at once: a word's crc is advanced by a blank and the next word for the pair.
3. Quickselect for the k-th key of all rows by (score descending, doc_id, tag, serial), a total order: a few random
   rows are pivots, one aggregate counts the rows before and at each of them exactly, and the interval that holds the
   k-th is the next round's table, until the k-th is a pivot.
4. The rows up to that key, and only those, are range-partitioned, sorted and numbered; ranges' sizes give offsets.

Defined cases: null text has no words; texts without features have weight 0; a null id hashes as ``7:`` and comes last
among ties; repeated rows are ranked one after the other; an empty table, or one without a text of ``MIN_WORDS`` words,
draws nothing; an empty target is possible (counts 0). Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm import words as W
from searchloom.llm.rows import texts_of
from searchloom.storage import written

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
PIVOTS = 31
LONG = 48  # words of more bytes are hashed one by one
WORD_BYTES = np.zeros(256, np.uint8)
WORD_BYTES[np.r_[48:58, 97:123, 128:256]] = np.r_[48:58, 97:123, 128:256]
WORD_BYTES[65:91] = np.arange(97, 123)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def _advance(crc: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Crc registers after the bytes of ``data`` from ``start`` on; all together, byte by byte."""
    crc = crc.copy()
    for i in np.flatnonzero(length > LONG).tolist():
        crc[i] = zlib.crc32(data[start[i] : start[i] + length[i]], int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    short = np.flatnonzero(length <= LONG)
    short = short[np.argsort(-length[short], kind="stable")]
    register, at = crc[short], start[short]
    ends = np.searchsorted(-length[short], -np.arange(1, LONG + 1), "right")  # how many have a further byte
    for place, n in enumerate(ends.tolist()):
        if not n:
            break
        now = register[:n]
        register[:n] = CRC[(now ^ data[at[:n] + place]) & np.uint32(255)] ^ (now >> np.uint32(8))
    crc[short] = register
    return crc


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the features of texts (no nulls), the text of each, and the number of words per text."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = WORD_BYTES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    solid = data != 0
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    first = np.searchsorted(start, offsets)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    one = _advance(np.full(len(start), 0xFFFFFFFF, np.uint32), data, start, length)
    paired = np.flatnonzero(of[1:] == of[:-1])
    blank = CRC[(one[paired] ^ np.uint32(32)) & np.uint32(255)] ^ (one[paired] >> np.uint32(8))
    two = _advance(blank, data, start[paired + 1], length[paired + 1])
    hashed = ~np.concatenate((one, two)) % np.uint32(buckets)
    return hashed.astype(np.int64), np.concatenate((of, of[paired])), np.diff(first)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in W.pieces(batch.column(0)):
                total += np.bincount(features(part, buckets)[0], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    counted = texts.select(texts[text].alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets`` rows
        result[row["bucket"]] = row["n"]
    return result


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: floor(1000 ln of how much more frequent it is in the target), counts smoothed by one."""
    in_source, in_target, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (float(in_source) + buckets) / ((float(s) + 1) * (float(in_target) + buckets))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``tag``, ``n_words``, ``n_features``, ``weight``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in W.pieces(batch.column(2)):
                hashed, of, n_words = features(part, len(sent.value))
                n = np.bincount(of, minlength=len(part))
                summed = np.bincount(of, sent.value[hashed], len(part)).astype(np.int64)  # whole numbers below 2**53
                own = batch.slice(row, len(part))
                yield pa.record_batch(
                    [own.column(0), own.column(1), *(pa.array(x, pa.int64()) for x in (n_words, n, summed // np.maximum(n, 1)))],
                    ["doc_id", "tag", "n_words", "n_features", "weight"],
                )

    return texts_of(docs, doc_id, text).select("doc_id", "tag", "text").mapInArrow(
        score, "doc_id long, tag long, n_words long, n_features long, weight long"
    )


def noisy(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` with ``score``: the weight and a Gumbel noise that the id determines."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return rows.withColumn("score", F.col("weight") + noise.cast("long"))


KEY = ["score", "doc_id", "tag", "serial"]
ORDER = [F.desc, F.asc_nulls_last, F.asc, F.asc]


def _order() -> list[Column]:
    return [by(c) for by, c in zip(ORDER, KEY, strict=True)]


def _before(key: dict) -> Column:
    """The row comes before ``key``."""
    known = F.lit(key["doc_id"]).cast("long")
    id_before = F.col("doc_id").isNotNull() if key["doc_id"] is None else F.coalesce(F.col("doc_id") < known, F.lit(False))
    steps = [F.col("score") > key["score"], id_before, F.col("tag") < key["tag"], F.col("serial") < key["serial"]]
    same = [F.col("score") == key["score"], F.col("doc_id").eqNullSafe(known), F.col("tag") == key["tag"]]
    return reduce(lambda rest, level: level[0] | (level[1] & rest), reversed(list(zip(steps[:-1], same, strict=True))), steps[-1])


def _at(key: dict) -> Column:
    return F.col("serial") == key["serial"]  # serials are unique


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> dict | None:
    """The ``k``-th key (from 1) of a written table by ``KEY``; None if k is 0. The table has at least k rows."""
    if k <= 0:
        return None
    rows, turn = rows.select(*KEY), 0
    while True:
        turn += 1
        dice = F.xxhash64(F.lit(turn), "serial")
        chosen = sorted(
            (row.asDict() for row in rows.orderBy(dice, "serial").limit(pivots).collect()),
            key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"] or 0, r["tag"], r["serial"]),
        )
        counts = rows.agg(*(F.count_if(_before(key)).alias(f"p{i}") for i, key in enumerate(chosen))).first()
        low = None
        for key, before in zip(chosen, counts, strict=True):
            if before == k - 1:
                return key
            if before >= k:
                high, passed = key, low
                break
            low = (key, before)
        else:
            high, passed = None, low
        if high is not None:
            rows = rows.where(_before(high))
        if passed is not None:
            rows, k = rows.where(~_before(passed[0]) & ~_at(passed[0])), k - passed[1] - 1
        rows = written(rows, "select-candidates")


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with ``rank`` from 1 by ``KEY``."""
    columns = winners.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            yield pa.record_batch(
                [*batch.columns, pa.array(np.arange(n + 1, n + 1 + len(batch)))], [*batch.schema.names, "nth"]
            )
            n += len(batch)

    schema = ", ".join(f"{name} {kind}" for name, kind in winners.dtypes)
    ordered = winners.repartitionByRange(*_order()).sortWithinPartitions(*_order()).withColumn("part", F.spark_partition_id())
    table = written(ordered.mapInArrow(number, schema + ", part int, nth long"), "drawn")
    offset, offsets = 0, []
    for row in table.groupBy("part").count().orderBy("part").collect():  # one row per range
        offsets.append((row["part"], offset))
        offset += row["count"]
    sizes = table.sparkSession.createDataFrame(offsets, "part int, offset long")
    return table.join(F.broadcast(sizes), "part").select(*columns, (F.col("nth") + F.col("offset")).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Every row's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where it isn't drawn)."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    rows = noisy(weighted(docs, gain, doc_id, text), seed).withColumn("serial", F.monotonically_increasing_id())
    rows = written(rows, "importance-scores")
    able = rows.where(F.col("n_words") >= min_words)
    last = kth_key(able, able.count() * percent // 100)
    shown = ["doc_id", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if last is None:
        return rows.select(*shown, nothing)
    drawn = (F.col("n_words") >= min_words) & (_before(last) | _at(last))
    winners = rows.where(drawn).select(*KEY, "n_features", "weight")
    return ranked(winners).select(*shown, "rank").unionByName(rows.where(~drawn).select(*shown, nothing))
