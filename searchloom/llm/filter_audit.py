"""Filter interaction audit: what each of five filters removes, in every order, from sorted posting lists.

A document fails A with under 50 words, B with 100 * different words < 65 * words, C with 100 * ``[A-Z]`` > 5 * code
points, D with any of ``#$%&*|``, E if a row with a smaller id has the same text, anywhere in the table.

1. One pass over the texts finds A to D. E needs no grouping of copies: the least id of each text (128-bit hash) is
   an aggregate, and a row fails unless it is that row, a join on hash and id in which no key is frequent.
2. Rows, without their texts, are range-partitioned by part, id and tag. Each task cuts its sorted rows in ranges of
   one part and at most ``RANGE`` rows, and keeps seven sorted posting lists per range: the rows that fail each
   filter, the good and the toxic ones. Postings are places in the range, so rows that share an id stay apart; ``ids``
   names them. A part of any size is many ranges; no task holds more than one.
3. Per range, unions of lists grow by galloping merges (the shorter list is searched in the longer, and the stretches
   in between are copied whole), differences by searching what is left. 80 sums say it all: for each filter and each
   set of filters before it, what is removed, and how much of that is good or toxic. Ranges are added up per part.
4. The 120 orders are looked up among those sums, 600 rows per part.

Defined cases: null text is empty text; a null part is the empty string; a row with a null id neither fails E nor makes
others fail it, and has no labels; rows with equal ids aren't copies of each other under E; of several labels for an id
one with the value 1 is enough; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm import words as W
from searchloom.llm.rows import keys_of
from searchloom.storage import written

FILTERS = "ABCDE"
RANGE = 65_536
LISTS = [*FILTERS, "good", "toxic"]
UPPER, MARK, INNER = (np.zeros(256, bool) for _ in range(3))
UPPER[65:91] = True
MARK[list(b"#$%&*|")] = True
INNER[128:192] = True  # bytes inside a code point
POSTINGS = "part string, n int, ids array<long>, " + ", ".join(f"`{name}` array<int>" for name in LISTS)
SUMS = "part string, filter int, before int, kept long, removed long, good_lost long, toxic_lost long"


def failures(docs: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``id``, ``tag``, ``doc_id``, ``part``, the text's hash ``h1``, ``h2``, and ``fails`` (bits 0 to 3 for A to D)."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts in W.pieces(batch.column(6)):
                words = W.words_of(texts)

                def counted(which: np.ndarray, words: W.Words = words) -> np.ndarray:
                    return np.diff(np.concatenate(([0], np.cumsum(which[words.data])))[words.text_at])

                n, points = np.diff(words.first), np.diff(words.text_at) - counted(INNER)
                hashes, of = W.word_hashes(words), words.text
                order = np.lexsort((hashes, of))
                hashes, of = hashes[order], of[order]
                new = np.ones(len(of), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
                different = np.bincount(of[new], minlength=len(texts))
                tests = (n < 50, 100 * different < 65 * n, 100 * counted(UPPER) > 5 * points, counted(MARK) > 0)
                fails = sum(failed.astype(np.int32) << bit for bit, failed in enumerate(tests))
                yield pa.record_batch([*batch.slice(row, len(texts)).columns[:6], pa.array(fails)], names)

    id_, tag = keys_of(docs, doc_id, text)
    content = F.coalesce(docs[text], F.lit(""))
    names = ["id", "tag", "doc_id", "part", "h1", "h2", "fails"]
    return docs.select(
        id_.alias("id"), tag.alias("tag"), docs[doc_id].cast("long").alias("doc_id"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), F.xxhash64(content).alias("h1"),
        F.xxhash64(F.lit(1), content).alias("h2"), content.alias("text"),
    ).mapInArrow(test, "id long, tag long, doc_id long, part string, h1 long, h2 long, fails int")


def judged(docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``part``, ``id``, ``tag``, ``doc_id`` and ``bits``: 0 to 4 for failing A to E, 5 good, 6 toxic."""
    rows = written(failures(docs, part, doc_id, text), "filter-failures")
    known = rows.where("doc_id IS NOT NULL")
    firsts = known.groupBy("h1", "h2").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    unknown = rows.where("doc_id IS NULL").withColumns({c: F.lit(None).cast("boolean") for c in ("first", "good", "toxic")})
    found = known.join(firsts.hint("merge"), ["h1", "h2", "id"], "left").join(marks.hint("merge"), "id", "left")
    copies = F.col("doc_id").isNotNull() & F.col("first").isNull()
    bits = F.col("fails") + sum(
        F.when(flag, F.lit(1 << place)).otherwise(F.lit(0)) for place, flag in ((4, copies), (5, F.col("good")), (6, F.col("toxic")))
    )
    return found.unionByName(unknown).select("part", "id", "tag", "doc_id", bits.alias("bits"))


def posting_lists(rows: DataFrame, most: int = RANGE) -> DataFrame:
    """One row per range of ids of a part: ``part``, ``n`` (its rows), ``ids`` (their doc_ids), and for each of ``LISTS``
    the sorted places of the rows on it. ``rows`` is the result of :func:`judged`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of one part, fewer than ``most``
        size = 0

        def close() -> pa.RecordBatch:
            bits = np.concatenate([b.column(2).to_numpy() for b in held])
            ids = pa.concat_arrays([b.column(1) for b in held])
            places = [np.flatnonzero(bits & (1 << k)).astype(np.int32) for k in range(len(LISTS))]
            columns = [held[0].column(0).slice(0, 1), pa.array([size], pa.int32())]
            columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, *map(pa.array, places))]
            return pa.record_batch(columns, ["part", "n", "ids", *LISTS])

        for batch in batches:
            if not len(batch):
                continue
            codes = batch.column(0).dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero(codes[1:] != codes[:-1]) + 1).tolist(), len(batch)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if held and held[-1].column(0)[-1] != batch.column(0)[low]:
                    yield close()
                    held, size = [], 0
                while low < high:
                    taken = min(high - low, most - size)
                    held.append(batch.slice(low, taken))
                    low, size = low + taken, size + taken
                    if size == most:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    ordered = rows.repartitionByRange("part", "id", "tag").sortWithinPartitions("part", "id", "tag")
    return ordered.select("part", "doc_id", "bits").mapInArrow(build, POSTINGS)


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sorted union of two sorted lists: the shorter is searched in the longer, stretches between are copied."""
    if len(a) < len(b):
        a, b = b, a
    at = np.searchsorted(a, b)
    new = b[(at == len(a)) | (a[np.minimum(at, len(a) - 1)] != b)] if len(a) else b
    return np.insert(a, np.searchsorted(a, new), new) if len(new) else a


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What of a sorted list is not on another one."""
    if not len(a) or not len(b):
        return a
    if len(b) < len(a):  # search the shorter one
        at = np.searchsorted(a, b)
        inside = at < len(a)
        found = at[inside][a[at[inside]] == b[inside]]
        return np.delete(a, found)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return a[b[at] != a]


def range_sums(n: int, failing: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """For each filter and set of filters before it (bits): rows kept after it, rows it removes, good and toxic ones of them."""
    unions = {0: np.zeros(0, np.int32)}
    for before in range(1, 1 << len(failing)):
        last = before.bit_length() - 1
        unions[before] = union(unions[before & ~(1 << last)], failing[last])
    result = []
    for k, mine in enumerate(failing):
        for before, gone in unions.items():
            if not before & (1 << k):
                removed = difference(mine, gone)
                lost = (len(removed) - len(difference(removed, x)) for x in (good, toxic))
                result.append((k, before, n - len(gone) - len(removed), len(removed), *lost))
    return result


def interactions(ranges: DataFrame) -> DataFrame:
    """Sums over posting lists, per ``part``, ``filter`` (0 to 4) and ``before`` (bits of the filters before it):
    ``kept``, ``removed``, ``good_lost``, ``toxic_lost``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                held = [batch.column(2 + k)[row].values.to_numpy() for k in range(len(LISTS))]
                sums = range_sums(batch.column(1)[row].as_py(), held[: len(FILTERS)], *held[len(FILTERS) :])
                columns = list(zip(*sums, strict=True))
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array([row] * len(sums))), *(pa.array(c, pa.int32()) for c in columns[:2]),
                        *(pa.array(c, pa.int64()) for c in columns[2:]),
                    ],
                    ["part", "filter", "before", "kept", "removed", "good_lost", "toxic_lost"],
                )

    totals = [F.sum(c).alias(c) for c in ("kept", "removed", "good_lost", "toxic_lost")]
    return ranges.select("part", "n", *LISTS).mapInArrow(add, SUMS).groupBy("part", "filter", "before").agg(*totals)


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "source", doc_id: str = "doc_id", text: str = "text", most: int = RANGE
) -> DataFrame:
    """The rows of query op13: per part, order of the filters and step, what is kept, removed and lost there."""
    sums = written(interactions(posting_lists(judged(docs, labels, part, doc_id, text), most)), "filter-sums")
    orders = ["".join(x) for x in permutations(FILTERS)]
    others = len(FILTERS) - 1
    lookup = [  # 600 rows
        (order, step + 1, FILTERS.index(letter), sum(1 << FILTERS.index(x) for x in order[:step]))
        for order in orders for step, letter in enumerate(order)
    ]
    steps = docs.sparkSession.createDataFrame(lookup, "filter_order string, step int, filter int, before int")
    size = F.bit_count("before")
    times = sum(F.when(size == s, F.lit(factorial(s) * factorial(others - s))).otherwise(F.lit(0)) for s in range(others + 1))
    whole = sums.groupBy("part", "filter").agg(
        F.max(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.max(F.when(size == others, F.col("removed"))).alias("unique_fails"), F.sum(F.col("removed") * times).alias("shapley"),
    )
    return sums.join(F.broadcast(steps), ["filter", "before"]).join(whole, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )
