"""BPE as a tokenization automaton: merges compiled one after the other, words encoded by its transitions.

The automaton reads token sequences and accepts those that the merges can produce. It begins with one state and a loop
for every symbol: any sequence of symbols. Each merge ``u v -> w``, in order of rank, adds one gadget:

* the state behind ``u`` is copied without its arc for ``v``, and all arcs for ``u`` now lead to the copy: ``u v``
  can no longer occur;
* wherever an arc for ``u`` leaves, an arc for ``w`` is added, to the state that ``v`` led to.

All arcs for a token lead to one state, so the automaton is deterministic, and copies keep most arcs. A state is
therefore stored as what it took away: pairs (token, rank), its own and those it inherited; a token inherits its
place from the token it starts with. An arc is present unless the state took away, in time, the token itself or
one that it starts with. ``arc`` works that out once per pair and keeps it in the transition table.

A word has one accepted path. For each position the table gives the one token that can end there behind the
state reached before, so encoding reads the word from left to right. The arcs' labels are the tokens; decoding
emits the labels of the ids.

Defined cases: null or empty text has no ids and decodes to ""; words of any length are encoded whole, in time
linear in their length; repeated rows and rows with a null id give a row each; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchloom.llm.vocabulary import WORD_BPE, ChunkIds, Memory, read_vocabulary, shared, spelt

START = -1
NEVER = 1 << 40
ARCS = 1 << 20  # remembered transitions
OUT_BYTES = 1 << 20  # of ids that are spelt out at a time


class Automaton:
    """States and arcs of a vocabulary's merges."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        self.ids, self.word_end = ids, word_end
        self.taken: dict[int, int] = {}  # (state of u, v) -> rank of the merge that took the arc away
        n = len(ids)
        self.born = [0] * n  # rank at which a token came into being
        self.head, self.tail = list(range(n)), list(range(n))  # the tokens that it was made of
        for rank, (left, right) in enumerate(merges, start=1):
            self.add_merge(rank, ids[left], ids[right], ids[left + right])
        self.longest = max(map(len, ids), default=1)
        self.arcs: dict[int, bool] = {}

    def add_merge(self, rank: int, u: int, v: int, w: int) -> None:
        """The gadget of one merge."""
        self.taken[u << 20 | v] = rank
        self.head[w], self.tail[w], self.born[w] = u, v, rank

    def arc(self, state: int, token: int) -> bool:
        """Whether the state behind ``state`` (a token, or START) has an arc for ``token``."""
        if state == START:
            return True
        key = state << 20 | token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._present(state, token)
        return known

    def _present(self, state: int, token: int) -> bool:
        until = NEVER  # the state holds what its token's last part had taken away when the token was born
        while True:
            start, before = token, NEVER
            while True:
                rank = self.taken.get(state << 20 | start)
                if rank is not None and rank < until and rank <= before:
                    return False
                if self.head[start] == start:
                    break
                start, before = self.head[start], self.born[start]
            if self.tail[state] == state:
                return True
            state, until = self.tail[state], min(until, self.born[state])

    def encode(self, word: str) -> list[int]:
        """Ids along the accepted path of a word of byte letters."""
        n, ids, longest = len(word), self.ids, self.longest
        reached, came = [START] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            final = self.word_end if end == n else ""
            for begin in range(max(0, end - longest), end):
                token = ids.get(word[begin:end] + final)
                if token is not None and self.arc(reached[begin], token):
                    reached[end], came[end] = token, begin
                    break
            else:
                raise ValueError("a symbol is not in the vocabulary")
        path, end = [], n
        while end:
            path.append(reached[end])
            end = came[end]
        return path[::-1]


class Codec(ChunkIds):
    """Encoding and decoding of texts with the automaton of a vocabulary file's text."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        settings = json.loads(vocabulary)
        model = settings["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in settings["added_tokens"]}
        if not self.chunks.by_chunk or settings["decoder"] is not None:
            raise ValueError("the automaton needs a vocabulary of words with word ends and no white space")
        labels = {i: s for s, i in [*model["vocab"].items(), *self.special.items()]}
        self.labels = pa.array([labels.get(i, "") for i in range(max(labels) + 1)])
        self.numbers = pa.array([str(i) for i in range(len(self.labels))])
        self.words = Memory(lambda word: tuple(self.automaton.encode(spelt(word))))

    def _word(self, word: str) -> tuple[int, ...]:
        return self.words[word]

    def _whole(self, text: str) -> list[int]:
        """Special tokens that the text spells out count as themselves."""
        found: list[int] = []
        while text:
            at, token = min(((text.find(s), s) for s in self.special if s in text), default=(len(text), ""))
            for word in self.chunks.pattern.findall(self.chunks.normal(text[:at])):
                found += self.words[word]
            if token:
                found.append(self.special[token])
            text = text[at + len(token) :]
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return np.frombuffer(self(text.encode()), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, as the library joins them."""
        return " ".join(self.labels.take(pa.array(ids, pa.uint32())).to_pylist())

    def joined(self, ids: list[bytes]) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Of texts' ids as :meth:`each` yields them: how many, themselves in decimal, and their labels, joined by one space."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        every = pa.array(np.frombuffer(b"".join(ids), "<u4"))
        spelt_out = (pc.binary_join(pa.ListArray.from_arrays(ends, names.take(every)), " ") for names in (self.numbers, self.labels))
        return pa.array(counts), *spelt_out


def encode_and_decode(docs: DataFrame, path: str = WORD_BPE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids`` (decimal, joined by one space) and ``decoded``."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared(Codec, vocabulary.value)
        for batch in batches:
            held, low, size = [], 0, 0
            for row, ids in enumerate(codec.each(batch.column(1).cast(pa.binary())), start=1):
                held.append(ids)
                size += len(ids)
                if size >= OUT_BYTES or row == len(batch):
                    columns = [batch.column(0).slice(low, row - low), *codec.joined(held)]
                    yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids", "decoded"])
                    held, low, size = [], row, 0

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids string, decoded string"
    )


def digest(docs: DataFrame) -> DataFrame:
    """The rows of query op10."""
    return encode_and_decode(docs).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
