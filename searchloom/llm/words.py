"""Words of whole texts as NumPy arrays: positions, hashes, windows, minimisers.

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``; bytes of other
code points are never among those). All functions work on a whole Arrow batch at once, straight
on its text buffer. Hashes are polynomials modulo 2**64 over random 64-bit values, mixed at the
end; the constants are fixed, so every task computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
PIECE_BYTES = 1 << 20


class Words(NamedTuple):
    """Words of ``len(first) - 1`` texts, one after the other."""

    data: np.ndarray  # bytes of all texts
    text_at: np.ndarray  # byte offsets of the texts, and their end
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # the byte after it
    first: np.ndarray  # index of each text's first word, and the number of words
    text: np.ndarray  # index of each word's text


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _byte_values(lower: bool, seed: int) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    if lower:
        values[65:91] = values[97:123]
    return values


_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Powers 0 .. n - 1 of an odd base, or of its inverse, modulo 2**64."""
    have = _powers.get((seed, inverse))
    if have is None or len(have) < n:
        base = (0xD1342543DE82EF95 + 16 * seed) % 2**64
        base = pow(base, -1, 2**64) if inverse else base
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[seed, inverse] = np.multiply.accumulate(steps)
    return have[:n]


def pieces(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, pa.Array]]:
    """Slices of whole texts of about ``PIECE_BYTES``, each with its first row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("")
    sizes = np.concatenate(([0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))))
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(sizes, sizes[row] + PIECE_BYTES, "right")) - 1)
        yield row, column.slice(row, stop - row)
        row = stop


def words_of(texts: pa.Array) -> Words:
    """Cut texts (no nulls) into words."""
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    solid = ~WHITE[data]
    edge = np.zeros(len(data) + 1, bool)  # a text begins here
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, first, text)


def word_hashes(words: Words, lower: bool = False, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; with ``lower``, A-Z count as a-z."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    n = len(words.data)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values(lower, seed)[words.data] * powers(n, seed), out=summed[1:])
    return mix((summed[words.end] - summed[words.start]) * powers(n, seed, True)[words.start])


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``k`` words from each position on; the last ``k - 1`` are missing."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(n, seed), out=summed[1:])
    return mix((summed[k:] - summed[:-k]) * powers(n, seed, True)[: n - k + 1])


def fits(words: Words, k: int) -> np.ndarray:
    """For each word but the last ``k - 1``: the window of ``k`` words lies in one text."""
    n = len(words.text)
    return words.text[: n - k + 1] == words.text[k - 1 :] if n >= k else np.zeros(0, bool)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    return best(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def minimisers(words: Words, grams: np.ndarray, k: int, span: int) -> np.ndarray:
    """Positions of the words at which a content-selected ``k``-gram begins.

    ``grams`` are the hashes of all ``k``-grams. In every run of ``span`` words of one text the
    smallest hashes are selected, ties included; so equal runs select equal positions, and
    every run of ``span`` words holds one.
    """
    width, n = span - k + 1, len(words.text)
    if n < span:
        return np.zeros(0, np.int64)
    values = np.maximum(grams, np.uint64(1))
    least = _sliding(values, width, np.minimum)
    least = np.where(fits(words, span), least, np.uint64(0))
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_sliding(padded, width, np.maximum) == values)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.view(np.int64)
