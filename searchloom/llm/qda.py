"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

Each text becomes a vector of statistics, transformed (logarithms and roots) towards bell shapes. Training sums
counts, vectors and products of the labelled rows in Spark; the driver sees one mean and one covariance per class.
A class covariance is shrunk towards the pooled one, and that towards its diagonal, so that it has a Cholesky
factor even where a statistic hardly varies. A score is the logistic function of the difference of the
log-densities (Mahalanobis distances by the cached factors) plus the log odds of the classes.

Defined cases: null and empty text have the statistics of an empty text and get a score like any other; labelled
rows without a document, and labels other than 0 and 1, don't count; with examples of less than two classes
every score is 0.5; repeated rows count as often as they occur; an empty table gives an empty result.
Columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchloom.llm.quality_rules import repeated_words
from searchloom.llm.rows import unused
from searchloom.storage import written

NAMES = (
    "bytes", "words", "word_length", "word_spread", "longest", "lines", "line_length", "same_lines", "symbols", "marks",
    "ends", "digits", "capitals", "other", "space", "different", "repeats", "short", "letters", "byte_entropy",
)
_IS = np.zeros((7, 256))
for _row, _bytes in enumerate((b"#*$%&|<>@~^_={}[]\\/", b",;:'\"()-", b".!?", b"0123456789", bytes(range(65, 91)), bytes(range(128, 256)), b" \t\n\r\x0b\x0c")):
    _IS[_row, list(_bytes)] = 1


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of :data:`NAMES`."""
    data = text.encode()
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    n, size = len(words), max(1, len(data))
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lengths = np.array([len(w) for w in words] or [0], float)
    share = np.sqrt(_IS @ counts / size)
    part = counts[counts > 0] / size
    return [
        math.log1p(len(data)), math.log1p(n), math.log1p(lengths.mean()), math.log1p(lengths.std()), math.log1p(lengths.max()),
        math.log1p(len(lines)), math.log1p(len(data) / max(1, len(lines))),
        math.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0,
        *share.tolist(),
        math.log1p(n) - math.log1p(len(set(words))),
        math.sqrt(repeated_words(text.split()) / n) if n else 0.0,
        math.sqrt(float((lengths <= 3).sum()) / n) if n else 0.0,
        math.sqrt(float(counts[97:123].sum()) / size),
        float(-(part * np.log(part)).sum()),
    ]


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``x``, the statistics of each row's whole text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(value.as_py() or "") for value in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(
        measure, f"doc_id {dict(docs.dtypes)[doc_id]}, x array<double>"
    )


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Model(NamedTuple):
    """Means, Cholesky factors of the covariances (lower), their log-determinants, and log class shares."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_shares: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        if not len(x) or not len(self.means):
            return np.full(len(x), 0.5)
        density = []
        for mean, factor, log_det, share in zip(*self, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(share - 0.5 * log_det - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def fit(examples: DataFrame, to_pooled: float = 0.1, to_diagonal: float = 0.01) -> Model:
    """Fit to rows of ``x`` and ``label`` (0 or 1); the two parameters are the shares of the shrinkage."""
    d = len(NAMES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            x = np.hstack((np.ones((len(x), 1)), x))
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                total[c] += x[label == c].T @ x[label == c]
        yield pa.record_batch([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["place", "value"])

    found = examples.where("label IN (0, 1)").select("x", F.col("label").cast("int")).mapInArrow(sums, "place int, value double")
    moments = np.zeros((2, d + 1, d + 1))
    for place, value in found.groupBy("place").agg(F.sum("value")).collect():  # 2 (d + 1)^2 numbers, whatever the input
        moments.flat[place] = value
    n = moments[:, 0, 0]
    if n.min() < 1:
        return Model(*[np.zeros((0, d))] * 4)
    means = moments[:, 0, 1:] / n[:, None]
    covariances = moments[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.einsum("c,cij->ij", n / n.sum(), covariances)
    floor = np.diag(np.diag(pooled) + 1e-6)
    shrunk = (1 - to_pooled) * covariances + to_pooled * pooled
    shrunk = (1 - to_diagonal) * shrunk + to_diagonal * floor
    factors = np.linalg.cholesky(shrunk)
    log_dets = 2 * np.log(np.einsum("cii->ci", factors)).sum(axis=1)
    return Model(means, factors, log_dets, np.log(n / n.sum()))


def score(vectors: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` and ``predicted`` to rows of ``doc_id`` and ``x``."""
    d = len(NAMES)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            found = model.scores(x)
            yield pa.record_batch(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return vectors.select("doc_id", "x").mapInArrow(
        rate, f"doc_id {dict(vectors.dtypes)['doc_id']}, score double, predicted int"
    )


def train(vectors: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit to the labelled rows that aren't held out."""
    known = labels.select("doc_id", F.col(label).alias("label")).where(~held_out())
    return fit(vectors.join(known, "doc_id"))


def without_low_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> DataFrame:
    """``docs`` without the rows that the classifier predicts as 0; all columns stay as they are."""
    model = train(features(docs, text=text), labels, label)
    (kept,) = unused(docs, "kept")
    place = docs.columns.index(text)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(value.as_py() or "") for value in batch.column(place)]).reshape(-1, len(NAMES))
            yield batch.append_column(kept, pa.array(model.scores(x) >= 0.5))

    schema = T.StructType([*docs.schema.fields, T.StructField(kept, T.BooleanType())])
    return docs.mapInArrow(rate, schema).where(F.col(kept)).drop(kept)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows of query op5: ``doc_id``, ``held_out``, ``score``, ``predicted`` for every document."""
    vectors = written(features(docs), "quality-statistics")
    return score(vectors, train(vectors, labels, label)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
