"""What the operators share on the DataFrame side: row keys, anchors, Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm import words as W


def keys_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """The columns ``id`` and ``tag`` that name a row: see :func:`texts_of`."""
    known, words = docs[doc_id].cast("long"), F.coalesce(docs[text], F.lit(""))
    unknown = F.shiftrightunsigned(F.xxhash64(F.lit("no id"), words), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(known, unknown), F.xxhash64(words, known)


def texts_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the text ("" for null) and ``id``, ``tag``, which together name a row.

    ``tag`` hashes text and id in 64 bits, and a row without an id gets another 62 bits of its text as
    ``id`` (beyond all usual ids). So rows that share an id, or have none, stay apart unless their
    texts agree as well; such repeated rows are alike in every result. Other columns are left out.
    """
    id_, tag = keys_of(docs, doc_id, text)
    return docs.select(
        id_.alias("id"), tag.alias("tag"), docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text")
    )


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column has them."""
    taken = {c.lower() for c in docs.columns}
    result = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        result.append(name)
    return result


def with_text(docs: DataFrame, new: Column, text: str = "text", length: str = "n_chars") -> list[Column]:
    """All columns of ``docs`` with another text, and its length if there is a column for it."""
    types = dict(docs.dtypes)
    return [
        new.alias(c) if c == text else F.length(new).cast(types[c]).alias(c) if c == length else F.col(f"`{c}`") for c in docs.columns
    ]


def anchors(texts: DataFrame, k: int, span: int) -> DataFrame:
    """Content-selected ``k``-grams: one in every run of ``span`` words of a text, equal ones in equal runs.

    Columns: ``gram`` (hash of the k words), ``id``, ``tag``, ``at`` (word index in the text).
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in W.pieces(batch.column(2)):
                words = W.words_of(part)
                grams = W.window_hashes(W.word_hashes(words), k)
                at = W.minimisers(words, grams, k, span)
                text = words.text[at]
                rows = pa.array(text + row)
                yield pa.record_batch(
                    [
                        pa.array(W.signed(grams[at])), batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array((at - words.first[text]).astype(np.int32)),
                    ],
                    ["gram", "id", "tag", "at"],
                )

    return texts.select("id", "tag", "text").mapInArrow(find, "gram long, id long, tag long, at int")


def range_hashes(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the words ``low`` to ``high`` (excluded), of any length, from word hashes."""
    n = len(hashes)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * W.powers(n, seed), out=summed[1:])
    return W.mix((summed[high] - summed[low]) * W.powers(n + 1, seed, True)[low])


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column (null: empty), one after the other, and the row of each."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def covered(n: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``n`` positions lie in one of the ranges ``low`` to ``high`` (excluded)."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, low, 1)
    np.add.at(steps, high, -1)
    return np.cumsum(steps[:-1]) > 0
