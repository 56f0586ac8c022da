"""Word-wise use of a public tokenizer's file: which texts fall apart into chunks, and ids chunk by chunk.

The operators take the path of a vocabulary file. The driver reads it and sends its text to the tasks; executors
need no file. Where the tokenizer drops white space and never looks across it, a text's ids are those of its
chunks between white space, and chunks that were seen before are looked up. All other cases (special tokens
spelt out in the text, control characters that libraries take for white space or not, other tokenizers) go
through the library as whole texts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CONTROLS = ("\x1c", "\x1d", "\x1e", "\x1f")
REMEMBERED = 150_000  # keys per Python worker; twice that at most
PIECES_REMEMBERED = 400_000  # words and chunks, about 40 bytes each
PART_BYTES = 1 << 21  # of texts that are cut into words at a time

# what a byte is: white space, a letter, a digit, of an ASCII word else, or one that needs the pattern
BLANK, LETTER, DIGIT, OTHER, HARD = range(5)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[list(b" \t\n\r\x0b\x0c")], KINDS[list(b"0123456789")], KINDS[128:], KINDS[ord("'")] = BLANK, DIGIT, HARD, HARD
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KINDS[65:91] = KINDS[97:123] = LETTER


def read_vocabulary(path: str = WORD_BPE) -> str:
    """The tokenizer file's text."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class Memory(dict):
    """Values by key, made on demand. When it holds ``remembered`` keys they become the former ones; former keys that
    are asked for come back, the others go the next time."""

    def __init__(self, make: Callable, remembered: int | None = None):
        self.make, self.former, self.remembered = make, {}, REMEMBERED if remembered is None else remembered

    def __missing__(self, key):
        if len(self) >= self.remembered:
            self.former = dict(self)
            self.clear()
        value = self.former.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it is printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


def spelt(word: str) -> str:
    """A word in byte letters."""
    if word.isascii() and word.isprintable():
        return word
    return "".join(map(byte_letters().__getitem__, word.encode()))


class Chunks:
    """How a tokenizer of this kind cuts text: NFC, lower case, words by a pattern, no white space."""

    def __init__(self, vocabulary: str):
        settings = json.loads(vocabulary)
        self.special = [t["content"] for t in settings["added_tokens"]]
        steps = (settings.get("normalizer") or {}).get("normalizers", [])
        cutter = ((settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_chunk = (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and cutter.get("behavior") == "Removed" and bool(cutter.get("invert"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in settings["added_tokens"])
        )
        self.pattern = regex.compile(cutter["pattern"]["Regex"]) if self.by_chunk else None
        self.ascii = (
            re.compile(cutter["pattern"]["Regex"].replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}\p{N}", "a-z0-9"), re.ASCII)
            if self.by_chunk else None
        )
        self.library = Tokenizer.from_str(vocabulary)

    def normal(self, text: str) -> str:
        """The normal form (NFC, each character in lower case)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if not text.isprintable() or max(text) > "ɏ":  # beyond Latin: the library knows its own edition of Unicode
            return self.library.normalizer.normalize_str(text)
        return "".join(map(str.lower, text))

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk without white space."""
        if chunk.isascii():
            return self.ascii.findall(chunk.lower())
        text = self.normal(chunk)
        return [text] if text.isalpha() and max(text) <= "ɏ" else self.pattern.findall(text)

    def falls_apart(self, text: str) -> bool:
        """Whether ``text.split()`` gives chunks that can be encoded one by one."""
        return self.by_chunk and not any(s in text for s in self.special) and not any(c in text for c in CONTROLS)


def gathered(values: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``chosen`` runs of ``values``, one after the other, and where each begins, and the end; run i begins at ``first[i]``."""
    lengths = first[chosen + 1] - first[chosen]
    begins = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))
    at = np.repeat(first[chosen] - begins[:-1], lengths)
    at += np.arange(begins[-1])
    return values[at], begins


class ChunkIds:
    """Ids of whole texts (UTF-8) by the library (subclasses: by ``_word``), as bytes of little-endian unsigned 32-bit numbers.

    Chunks are cut at ASCII white space; any other white space is left to the pattern. ASCII chunks without an apostrophe
    are cut into words on bytes, a part of the texts at a time. The different pieces (such words, and other chunks as
    they stand) of a part are looked up among those of earlier parts; when more than ``PIECES_REMEMBERED`` are known, the
    part's own stay."""

    def __init__(self, vocabulary: str):
        self.chunks = Chunks(vocabulary)
        self.library = self.chunks.library
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.apart = [s.encode() for s in (*self.chunks.special, *CONTROLS)]
        self.known = pa.array([], pa.large_binary())
        self.first, self.ids = np.zeros(1, np.int64), np.zeros(0, "<u4")  # the ids of all known pieces

    def _word(self, word: str) -> Sequence[int]:
        return [token.id for token in self.model.tokenize(spelt(word))]

    def _whole(self, text: str) -> list[int]:
        """Ids of a text that doesn't fall apart."""
        return self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: bytes) -> list[int]:
        """Ids of a lower-case ASCII word, or of a chunk that needs the pattern."""
        text = piece.decode()
        words = [text] if text.isascii() and "'" not in text else self.chunks.words(text)
        return [i for word in words for i in self._word(word)]

    def _learn(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece is among the known ones, with the new ones added."""
        place = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(place.is_null())
        found = list(map(self._piece, new.to_pylist()))
        place = place.to_numpy(zero_copy_only=False) if not len(new) else place.fill_null(-1).to_numpy()
        place = np.where(place < 0, np.cumsum(place < 0) - 1 + len(self.known), place).astype(np.int64)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.known = pa.concat_arrays([self.known, new])
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(lengths)))
        self.ids = np.concatenate((self.ids, np.fromiter((i for ids in found for i in ids), "<u4", int(lengths.sum()))))
        if len(self.known) > PIECES_REMEMBERED:
            self.ids, self.first, self.known = *gathered(self.ids, self.first, place), pieces
            place = np.arange(len(pieces))
        return place

    def __call__(self, text: bytes) -> bytes:
        return next(self.each(pa.array([text], pa.binary())))

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text (binary; null: none), in order."""
        part, size = [], 0
        for text in texts:
            part.append(text.as_py() or b"")
            size += len(part[-1])
            if size >= PART_BYTES:
                yield from self._part(part)
                part, size = [], 0
        yield from self._part(part)

    def _part(self, texts: list[bytes]) -> Iterator[bytes]:
        apart = [self.chunks.by_chunk and not any(x in text for x in self.apart) for text in texts]
        found = self._cut([text for text, yes in zip(texts, apart, strict=True) if yes])
        for text, yes in zip(texts, apart, strict=True):
            if yes:
                yield next(found)
            else:
                yield np.array(self._whole(text.decode()), "<u4").tobytes()

    def _cut(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of texts that fall apart."""
        ends = np.cumsum([len(text) + 1 for text in texts])
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)  # a blank after each text
        kinds = KINDS[data]
        inside = kinds != BLANK
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        starts = np.flatnonzero(starts)
        if not len(starts):
            yield from [b""] * len(texts)
            return
        chunk = (np.cumsum(np.bincount(starts, minlength=len(data)), dtype=np.int32) - 1)[inside]  # of each byte that is left
        hard = np.zeros(len(starts), bool)
        kept, kinds = data[inside], kinds[inside]
        hard[chunk[kinds == HARD]] = True
        as_is = hard[chunk]
        kinds[as_is] = HARD
        kept = np.where(as_is, kept, LOWER[kept])
        first = np.ones(len(kept), bool)
        first[1:] = (chunk[1:] != chunk[:-1]) | (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
        first = np.flatnonzero(first)
        offsets = np.append(first, len(kept)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
        ).dictionary_encode()
        place = self._learn(pieces.dictionary)[pieces.indices.to_numpy()]
        ids, upto = gathered(self.ids, self.first, place)
        upto = (4 * upto[np.searchsorted(np.flatnonzero(inside)[first], ends)]).tolist()
        del data, kinds, inside, starts, chunk, kept, as_is, first, offsets, pieces, place
        data, low = memoryview(ids).cast("B"), 0
        for high in upto:
            yield bytes(data[low:high])
            low = high


_made: dict[tuple[type, int], object] = {}


def shared(kind: type, vocabulary: str):
    """One object of a kind per Python worker and vocabulary."""
    key = (kind, hash(vocabulary))
    if key not in _made:
        _made[key] = kind(vocabulary)
    return _made[key]
