"""Quality rules, line first: bad lines go, then documents that lose too much of their text.

Each line with a word is judged alone:

* punctuation: most of its words carry no letter, or symbols ``#*$%&|<>`` make up a quarter of its characters;
* navigation: it is a menu (three or more parts between ``|``, ``>`` or bullets), or a heading of up to three
  words without a mark at its end that other lines of the text repeat;
* boilerplate: it holds one of :data:`BOILERPLATE`.

Then the document is judged: it must keep ``min_kept`` of its word characters. ``kept`` also asks that the base
rules pass: at least 50 words, and at most half of the words in repeated 3-word windows. ``kept_text`` is the text
without its bad lines, whatever the document's verdict; lines without a word stay.

One pass over whole texts, no shuffle. Defined cases: null or empty text has no words, fails the base rules and has an empty ``kept_text``;
rows with a null id and repeated rows each give their own row; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEATED = 50  # percent
MIN_KEPT = 0.5
SYMBOLS = re.compile(r"[#*$%&|<>]")
PARTS = re.compile(r"[\x20\x09-\x0D](?:[|>•·»]|-{1,2}>?)[\x20\x09-\x0D]")
LETTER = regex.compile(r"\p{L}")
BOILERPLATE = re.compile(
    r"all rights reserved|cookie|privacy policy|terms of (?:use|service)|subscribe|newsletter|click here|"
    r"sign (?:in|up)|log ?in|javascript|lorem ipsum",
    re.IGNORECASE | re.ASCII,
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bad_lines long, kept_chars long, base_failed boolean, kept boolean, kept_text string"
)


def repeated_words(words: list[str]) -> int:
    """Words in 3-word windows that occur twice or more, their first occurrences included."""
    if len(words) < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    n = len(numbers)
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, place, count = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    twice = np.zeros(len(words) + 2, bool)
    twice[2:-2] = count[place] > 1
    return int((twice[2:] | twice[1:-1] | twice[:-2]).sum())


def line_fails(line: str, words: list[str], repeated: bool) -> bool:
    """Whether a line with words fails the punctuation, navigation or boilerplate rules."""
    chars = sum(map(len, words))
    if 4 * len(SYMBOLS.findall(line)) >= chars:
        return True
    if 2 * sum(1 for w in words if LETTER.search(w)) < len(words):
        return True
    if len(PARTS.findall(line)) >= 2 or BOILERPLATE.search(line):
        return True
    return repeated and len(words) <= 3 and words[-1][-1] not in ".!?:;"


def judge(text: str, min_kept: float = MIN_KEPT) -> tuple[int, int, int, int, int, int, int, bool, bool, str]:
    """The statistics, both verdicts and the kept lines of one text, in the order of :data:`SCHEMA`."""
    words, chars, kept, bad, duplicates, stay = [], 0, 0, 0, 0, []
    lines = text.split("\n")
    counts: dict[str, int] = {}
    for line in lines:
        counts[line] = counts.get(line, 0) + 1
    seen = set()
    for line in lines:
        own = WORD.findall(line)
        if not own:
            stay.append(line)
            continue
        size = sum(map(len, own))
        words += own
        chars += size
        duplicates += line in seen
        seen.add(line)
        if line_fails(line, own, counts[line] > 1):
            bad += 1
        else:
            kept += size
            stay.append(line)
    n, repeats = len(words), repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEATED * n
    verdict = not failed and kept >= min_kept * chars
    return n, chars, len(SYMBOLS.findall(text)), duplicates, repeats, bad, kept, failed, verdict, "\n".join(stay) if bad else text


def quality_rules(docs: DataFrame, min_kept: float = MIN_KEPT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the columns of :data:`SCHEMA`."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 7 + [pa.bool_()] * 2 + [pa.string()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            rows = [judge(value.as_py() or "", min_kept) for value in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(rate, SCHEMA)


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op2."""
    return quality_rules(docs).drop("kept_text")
