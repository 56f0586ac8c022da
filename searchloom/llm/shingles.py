"""Sets of word shingles, as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from searchloom.llm import words as W
from searchloom.llm.rows import range_hashes

K = 4


def all_sets(part: pa.Array, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each text, sorted, one text after the other; and where each text's begin, and the end."""
    words = W.words_of(part)
    hashes = W.word_hashes(words, lower=True)
    inside = np.flatnonzero(W.fits(words, k))
    values, text = W.window_hashes(hashes, k)[inside], words.text[inside]
    lengths = np.diff(words.first)
    short = np.flatnonzero((lengths > 0) & (lengths < k))
    if len(short):
        whole = range_hashes(hashes, words.first[short], words.first[short + 1], seed=2)
        values, text = np.concatenate((values, whole)), np.concatenate((text, short.astype(text.dtype)))
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[keep], np.searchsorted(text[keep], np.arange(len(part) + 1))


def shingle_sets(part: pa.Array, k: int = K) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text."""
    values, first = all_sets(part, k)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield values[low:high]
