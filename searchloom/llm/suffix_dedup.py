"""Suffix-array dedup with a sparse suffix array over content-selected positions.

1. Suffixes are retained at minimisers of 25-word grams: every run of 50 words holds one, at the same place in all
   its copies. Suffixes whose first 25 words are found once can't be in a repeated run and are dropped.
2. A retained suffix is its next 25 words, and what may extend it to a run of 50: 25 words to the right and 25 to the
   left, as word hashes. Suffixes with all of that in common are one entry with one row, whatever their number.
3. Entries are brought together by their first 25 words and sorted. A match reaches ``y`` words further to the
   right and ``25 - y`` to the left; for each ``y`` the entries are sorted by what such a match has in common, and
   neighbours are compared. The least and the greatest ``y`` with a match say how far the run reaches.

So a word is repeated exactly if a run of ``m`` words (50) around it occurs elsewhere too, in the same document
or another. Where more than ``bucket`` entries begin alike, they aren't sorted in one task: their keys for each
``y`` are counted by Spark, with partial sums before the shuffle, to the same result.

Defined cases: null or empty text has no words; texts of fewer than ``m`` words have no repeated run; repeated rows are
copies of each other; a null id is an id like any other, lower than none; an empty table gives an empty result.
Of equal runs the first is the one with the lowest (id, tag, position). Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom.llm import words as W
from searchloom.llm.rows import anchors, covered, keys_of, lists, texts_of, unused, with_text
from searchloom.storage import written

KEY = ["id", "tag"]
ENTRY = "gram long, context long, right binary, left binary, id long, tag long, at int"


def _around(words: W.Words, hashes: np.ndarray, at: np.ndarray, text: np.ndarray, k: int, m: int):
    """Hashes of the words that may extend each suffix: (suffixes, m - k) to the right and to the left (nearest
    first), 0 where the text has ended."""
    steps = np.arange(m - k)
    short = np.maximum(hashes.astype(np.uint32), np.uint32(1))
    last = len(hashes) - 1

    def pick(place: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return np.where(inside, short[np.clip(place, 0, last)], np.uint32(0))

    right, left = at[:, None] + k + steps, at[:, None] - 1 - steps
    return pick(right, right < words.first[text + 1][:, None]), pick(left, left >= words.first[text][:, None])


def split_keys(gram: np.ndarray, right: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each ``y``: a hash of the gram, ``y`` words to the right and the rest to the left; and whether they exist."""
    free = right.shape[1]

    def prefixes(side: np.ndarray, seed: int) -> np.ndarray:
        summed = np.zeros((len(side), free + 1), np.uint64)
        np.cumsum(W.mix(side.astype(np.uint64) + np.uint64(seed)) * W.powers(free, seed), axis=1, out=summed[:, 1:])
        return summed

    rights, lefts = prefixes(right, 1), prefixes(left, 2)
    n_right, n_left = (right > 0).sum(axis=1), (left > 0).sum(axis=1)
    for y in range(free + 1):
        key = W.mix(gram ^ W.mix(rights[:, y] ^ W.mix(lefts[:, free - y] + np.uint64(y))))
        yield y, key, (n_right >= y) & (n_left >= free - y)


def _matrix(column: pa.Array, free: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), free)


def _match(gram: np.ndarray, right: np.ndarray, left: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """Least and greatest ``y`` with a match (-1: none) of each entry; and the same of matches with an earlier one."""
    n = len(gram)
    low, high, low_later, high_later = (np.full(n, -1, np.int32) for _ in range(4))
    for y, key, exists in split_keys(gram, right, left):
        place = np.flatnonzero(exists)
        place = place[np.lexsort((rank[place], key[place]))]
        same = key[place[1:]] == key[place[:-1]]  # neighbours
        later = place[1:][same]
        for found, first, last in ((np.concatenate((later, place[:-1][same])), low, high), (later, low_later, high_later)):
            first[found] = np.where(first[found] < 0, y, first[found])
            last[found] = y
    return [low, high, low_later, high_later]


def run_spans(
    docs: DataFrame, m: int = 50, bucket: int = 20_000, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row (``id``, ``tag``) with a repeated run: arrays ``repeated`` and ``later`` of runs of words (``start``, ``end``).

    ``later`` holds what occurs earlier as well. Runs may overlap and reach beyond the text."""
    k = m // 2
    free = m - k
    texts = texts_of(docs, doc_id, text)
    found = anchors(texts, k, m)
    repeated = written(found.groupBy("gram").count().where("count > 1").select("gram"), "suffix-grams")
    kept = found.join(repeated.hint("merge"), "gram", "left_semi")
    kept = written(kept.groupBy(*KEY).agg(F.sort_array(F.collect_set("at")).alias("ats")), "suffixes")

    def look_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, rows = lists(batch.column(3))
            for row, part in W.pieces(batch.column(2)):
                words = W.words_of(part)
                mine = slice(*np.searchsorted(rows, [row, row + len(part)]))
                document = rows[mine] - row
                at = values[mine] + words.first[document]
                hashes = W.word_hashes(words)
                grams = W.window_hashes(hashes, k)[at]
                right, left = _around(words, hashes, at, document, k, m)
                both = np.hstack((right, left)).astype(np.uint64)
                context = W.mix((W.mix(both + np.uint64(3)) * W.powers(2 * free, 3)).sum(axis=1, dtype=np.uint64))
                where = pa.array(rows[mine])
                yield pa.record_batch(
                    [
                        pa.array(W.signed(grams)), pa.array(W.signed(context)),
                        pa.array([x.tobytes() for x in right], pa.binary()), pa.array([x.tobytes() for x in left], pa.binary()),
                        batch.column(0).take(where), batch.column(1).take(where), pa.array(values[mine].astype(np.int32)),
                    ],
                    ["gram", "context", "right", "left", "id", "tag", "at"],
                )

    suffixes = written(texts.join(kept.hint("merge"), KEY).select(*KEY, "text", "ats").mapInArrow(look_around, ENTRY), "suffix-rows")
    entries = suffixes.groupBy("gram", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "tag", "at")).alias("head"),
        F.min("right").alias("right"), F.min("left").alias("left"),
    )
    entries = written(entries, "suffix-entries")
    sizes = entries.groupBy("gram").count().where("count > 1")
    small = entries.join(sizes.where(F.col("count") <= bucket).select("gram"), "gram", "left_semi")
    large = entries.join(sizes.where(F.col("count") > bucket).select("gram"), "gram", "left_semi")
    matched = "gram long, context long, low int, high int, low_later int, high_later int"
    names = [part.split()[0] for part in matched.split(", ")]

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = table.combine_chunks().to_batches()
            if rows:
                rows = rows[0]
                rank = np.empty(len(rows), np.int64)
                rank[np.lexsort([rows.column(i).to_numpy() for i in (6, 5, 4)])] = np.arange(len(rows))
                gram = rows.column(0).to_numpy().view(np.uint64)
                result = _match(gram, _matrix(rows.column(2), free), _matrix(rows.column(3), free), rank)
                yield pa.record_batch([rows.column(0), rows.column(1), *map(pa.array, result)], names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            gram = table.column(0).to_numpy()
            whole = int(np.searchsorted(gram, gram[-1])) if len(gram) else 0
            yield from compare(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None:
            yield from compare(held)

    columns = ["gram", "context", "right", "left", "head.id", "head.tag", "head.at"]
    near = small.select(columns).repartition("gram").sortWithinPartitions("gram", "right").mapInArrow(neighbours, matched)

    def spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column(0).to_numpy().view(np.uint64)
            for y, key, exists in split_keys(gram, _matrix(batch.column(2), free), _matrix(batch.column(3), free)):
                rows = batch.filter(pa.array(exists))
                yield pa.record_batch(
                    [*(rows.column(i) for i in (0, 1, 4, 5, 6)), pa.array([y] * len(rows), pa.int32()), pa.array(W.signed(key[exists]))],
                    ["gram", "context", "id", "tag", "at", "y", "key"],
                )

    spelt = large.select(columns).mapInArrow(spell_out, "gram long, context long, id long, tag long, at int, y int, key long")
    heads = spelt.groupBy("gram", "y", "key").agg(F.count("*").alias("n"), F.min(F.struct("id", "tag", "at")).alias("head")).where("n > 1")
    y_later = F.when(F.struct("id", "tag", "at") != F.col("head"), F.col("y"))
    far = spelt.join(heads, ["gram", "y", "key"]).groupBy("gram", "context").agg(
        F.min("y").alias("low"), F.max("y").alias("high"),
        F.coalesce(F.min(y_later), F.lit(-1)).alias("low_later"), F.coalesce(F.max(y_later), F.lit(-1)).alias("high_later"),
    )
    reach = written(near.unionByName(far).where("low >= 0"), "suffix-matches")

    known = entries.select("gram", "context", "n", "head").join(reach, ["gram", "context"], "left").where("n > 1 OR low >= 0")
    rows = suffixes.select("gram", "context", *KEY, "at").join(known, ["gram", "context"])
    is_head = F.struct("id", "tag", "at") == F.col("head")

    def run(low, high):
        return F.struct((F.col("at") - free + low).alias("start"), (F.col("at") + k + high).alias("end"))

    # copies of an entry have all that surrounds them in common, as far as their texts go
    every = F.struct((F.col("at") - free).alias("start"), (F.col("at") + m).alias("end"))
    spans = rows.select(
        *KEY, F.when(F.col("n") > 1, every).otherwise(run(F.col("low"), F.col("high"))).alias("repeated"),
        F.when(~is_head, every).when(F.col("low_later") >= 0, run(F.col("low_later"), F.col("high_later"))).alias("later"),
    )
    spans = spans.groupBy(*KEY).agg(F.collect_set("repeated").alias("repeated"), F.collect_set("later").alias("later"))
    return written(spans, "suffix-spans")


def _runs(n: int, spans: list | None) -> list[tuple[int, int]]:
    """Spans, cut to a text of ``n`` words, as separate runs in order."""
    if not spans:
        return []
    low = np.clip([s["start"] for s in spans], 0, n)
    high = np.clip([s["end"] for s in spans], 0, n)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered(n, low, high).astype(np.int8), [0]))))
    return [tuple(x) for x in edges.reshape(-1, 2).tolist()]


def repeated_passages(docs: DataFrame, m: int = 50, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of query op9, one per passage: ``doc_id``, ``start_word``, ``end_word`` (the word after it), ``n_words``
    and ``first`` (nothing in it occurs earlier). Passages are as long as their words are repeated in runs of ``m``;
    documents without one have no row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, firsts = [], [], [], []
            for row, (value, spans, later) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)):
                n = len(value.encode().split())
                known = _runs(n, later)
                for start, end in _runs(n, spans):
                    rows.append(row)
                    starts.append(start)
                    ends.append(end)
                    firsts.append(not any(a < end and b > start for a, b in known))
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(rows, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()),
                    pa.array(firsts, pa.bool_()),
                ],
                ["doc_id", "start_word", "end_word", "first"],
            )

    spans = run_spans(docs, m, doc_id=doc_id, text=text, **options)
    runs = texts_of(docs, doc_id, text).join(spans.hint("merge"), KEY)
    return runs.select("doc_id", "text", "repeated", "later").mapInArrow(
        find, "doc_id long, start_word int, end_word int, first boolean"
    ).withColumn("n_words", F.col("end_word") - F.col("start_word"))


def without_later(docs: DataFrame, m: int = 50, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the passages that occur earlier; a row that loses all its words goes.

    White space stays as it is around what is kept. Other columns stay, but ``n_chars`` follows the text."""
    spans = run_spans(docs, m, doc_id=doc_id, text=text, **options).where(F.size("later") > 0)
    id_, tag, later, kept = unused(docs, "id", "tag", "later", "kept")
    mine = spans.select(F.col("id").alias(id_), F.col("tag").alias(tag), F.col("later").alias(later))
    place = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, left = batch.column(place).to_pylist(), []
            for k, spans_ in enumerate(batch.column(len(batch.columns) - 1).to_pylist()):
                any_left = True
                if spans_:
                    words = W.words_of(pa.array([values[k]]))
                    data, n, rest, at, lost = values[k].encode(), len(words.start), [], 0, 0
                    for start, end in _runs(n, spans_):
                        lost += end - start
                        rest.append(data[at : int(words.start[start])])
                        at = int(words.start[end]) if end < n else len(data)
                    values[k] = b"".join([*rest, data[at:]]).decode()
                    any_left = lost < n
                left.append(any_left)
            batch = batch.set_column(place, text, pa.array(values, pa.string()))
            yield batch.set_column(len(batch.columns) - 1, kept, pa.array(left, pa.bool_()))

    keys = docs.withColumns(dict(zip((id_, tag), keys_of(docs, doc_id, text), strict=True)))
    joined = keys.join(mine.hint("merge"), [id_, tag], "left").select(*(f"`{c}`" for c in docs.columns), later)
    schema = T.StructType([*docs.schema.fields, T.StructField(kept, T.BooleanType())])
    rest = joined.mapInArrow(cut, schema).where(F.col(kept)).drop(kept)
    return rest.select(with_text(rest, F.col(text), text))
