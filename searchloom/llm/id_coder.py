"""Range coder for token ids: predictions of order 2, 1 and 0 are mixed and drive the coder, block by block.

Each block begins with an empty model and can be read alone. For every id the model has

* order 2: the id that followed the last two ids (hashed), with a count of how often in a row it was right,
* order 1: the same for the last id,
* order 0: how often each id occurred in the block so far (its latest ``WINDOW`` ids), counted anew when an eighth has
  come in, or ``EVERY`` ids,
* literal: an id that none of them has, written out.

The mixture shares the range out among the four. Its weights are kept by how sure orders 1 and 2 are (both counts, and
whether they agree) and move towards what was right. The coder has a 48-bit state and 16-bit output; carries are
added to the output at the end.

Blocks are independent, so a task codes many side by side: each NumPy operation does one step of one id in all of
them. ``encode`` and ``decode`` run the same model in the same order with whole numbers only; those of the interval are
held in doubles, which are exact up to 2^53.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAGIC = b"IDR2"
CONTEXTS, RUN_BITS = 1 << 11, 3
RUNS = 1 << RUN_BITS
STATES = 2 * RUNS * RUNS
SHARES = 14  # bits of the mixture's whole
RATE, LEFT = 4, 64  # how fast weights move, and what an unlikely share moves to
TWO, ONE, LITERAL, OLD = range(4)
FIRST, PART, EVERY, WINDOW = 16, 8, 512, 1 << 14
TOP, BOTTOM, WORD = 2.0**48, 2.0**32, 2.0**16
LARGEST = 1 << 20  # ids
SIDE_BY_SIDE = 1024

# Where the four shares begin, 16 bits each, packed in one number: at first, and what each outcome adds in a step.
_EACH, _LOW = 0x0001_0001_0001_0001, (1 << SHARES) - 1  # the last bit of every field, a field
_OVER = _EACH << SHARES
_KEPT = ((1 << 16 - RATE) - 1) * _EACH
_EVEN = sum(k << (SHARES - 2) + 16 * k for k in range(4))
_DRAWN = np.array([
    sum(sum(LEFT if j != right else (1 << SHARES) - 3 * LEFT for j in range(k)) >> RATE << 16 * k for k in range(4)) for right in range(4)
])


class Model:
    """Orders 1 and 2 of ``b`` blocks, and the mixture."""

    def __init__(self, b: int):
        lanes = np.arange(b)
        self.held = np.zeros(2 * b * CONTEXTS, np.int32)  # id and run
        self.rows = np.stack([lanes, lanes + b]) * CONTEXTS
        self.mixture, self.states = np.full(b * STATES, _EVEN), lanes * STATES

    def places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Where the followers of the last id and of the last two are held, for the first blocks; in the last two axes."""
        m = one.shape[-1]
        found = np.empty((*one.shape[:-1], 2, m), np.int64)
        np.bitwise_and(one, CONTEXTS - 1, out=found[..., 0, :])
        mixed = one * 0x2C1B3C6D
        mixed += two * 0x297A2D39
        mixed >>= 12
        np.bitwise_and(mixed, CONTEXTS - 1, out=found[..., 1, :])
        found += self.rows[:, :m]
        return found

    def predict(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of orders 1 and 2, and where the four shares begin."""
        self.at, self.now = places, self.held.take(places, mode="clip")
        ids = self.now >> RUN_BITS
        run = self.now.astype(np.int8)
        run &= RUNS - 1
        state = (ids[0] == ids[1]).view(np.int8)
        for one in run:
            state <<= RUN_BITS
            state |= one
        self.state = state.astype(np.int64)
        self.state += self.states[: len(state)]
        self.begins = self.mixture.take(self.state, mode="clip")
        return ids, self.begins

    def learn(self, x: np.ndarray, right: np.ndarray, which: np.ndarray) -> None:
        """Take in this step's ids, whether orders 1 and 2 had them, and which share coded them."""
        down = self.begins >> RATE
        down &= _KEPT
        self.begins -= down
        self.begins += _DRAWN.take(which, mode="clip")
        self.mixture[self.state] = self.begins
        more = self.now + 1
        self.now |= RUNS - 1
        self.held[self.at] = np.where(right, np.minimum(more, self.now), x << RUN_BITS)


def _taken(begins: np.ndarray, which: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chosen shares begin, and how wide they are, ``part`` being the range over the whole."""
    which = which << 4
    low = begins >> which
    wide = begins >> 16
    wide >>= which
    wide -= low
    wide &= _LOW
    low &= _LOW
    return low * part, wide * part


def _stretches(longest: int) -> Iterator[tuple[int, int, int]]:
    """From where to where order 0 stays, and over how many of the ids before."""
    low, high = 0, FIRST
    while low < longest:
        yield low, min(high, longest), min(low, WINDOW)
        low, high = high, high + min(max(high // PART, FIRST), EVERY)


def _runs(latest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row's ids in order: where equal ones begin (in the slots of all rows), how many they are, and the id."""
    ordered = np.sort(latest, axis=1, kind="stable")
    first = np.ones(latest.shape, bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=first[:, 1:])
    at = np.flatnonzero(first)
    return at, np.diff(at, append=latest.size), ordered.ravel()[at].astype(np.int64)


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many blocks (longest first) have an id at each step."""
    return np.searchsorted(-lengths, -np.arange(lengths.max(initial=0)), "left")


def encode(blocks: list[np.ndarray], size: int) -> list[bytes]:
    """Code each array of ids below ``size``."""
    if size > LARGEST:
        raise ValueError(f"a vocabulary has {LARGEST} ids at most")
    result: list[bytes] = [b""] * len(blocks)
    by_length = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    for low in range(0, len(blocks), SIDE_BY_SIDE):
        chosen = by_length[low : low + SIDE_BY_SIDE]
        for k, coded in zip(chosen, _encode([blocks[k] for k in chosen], size), strict=True):
            body = struct.pack("<II", len(blocks[k]), zlib.crc32(blocks[k].astype("<u4").tobytes())) + coded
            result[k] = MAGIC + struct.pack("<I", zlib.crc32(body)) + body
    return result


def _order0(ids: np.ndarray, begin: int, end: int, n: int, size: int) -> np.ndarray:
    """First slot and number of slots of the ids from ``begin`` to ``end`` among the ``n`` ids before, packed; none: 0."""
    found, looked = np.zeros(size, np.int64), np.zeros((len(ids), end - begin), np.int64)
    if n:
        at, many, which = _runs(ids[:, begin - n : begin])
        packed, rows = (at % n) << 16 | many, np.searchsorted(at, np.arange(len(ids) + 1) * n).tolist()
        for k, (low, high) in enumerate(zip(rows[:-1], rows[1:])):  # one block at a time
            found[which[low:high]] = packed[low:high]
            found.take(ids[k, begin:end], out=looked[k], mode="clip")
            found[which[low:high]] = 0
    return looked.T


def _encode(blocks: list[np.ndarray], size: int) -> list[bytes]:
    b, lengths = len(blocks), np.array([len(x) for x in blocks])
    ids = np.zeros((b, lengths.max(initial=0)), np.uint16 if size <= 1 << 16 else np.int32)
    for k, block in enumerate(blocks):
        ids[k, : len(block)] = block
    active = _active(lengths).tolist()
    model, low, width = Model(b), np.zeros(b), np.full(b, TOP)
    room = ids.shape[1] * (size.bit_length() + SHARES) // 16 + 8  # words; an id has less bits
    out, used = np.zeros(b * room, np.uint32), np.arange(b) * room
    before = np.zeros((2, b), np.int32)  # the last two ids of each block
    for begin, end, n in _stretches(ids.shape[1]):
        m = active[begin]
        here = np.concatenate((before[:, :m], ids[:m, begin:end].T), dtype=np.int32)
        past, before, here = here[:2], here[-2:], here[2:]
        old = _order0(ids[:m], begin, end, n, size)
        is_old = old > 0
        past = np.concatenate((past, here), dtype=np.int64)
        places = model.places(past[1:-1], past[:-2])
        plain = np.where(is_old, np.int8(OLD), np.int8(LITERAL))
        starts, shares = np.where(is_old, old >> 16, here).astype(float), np.where(is_old, (old & 0xFFFF) - 1, 0).astype(float)
        wholes = np.where(is_old, n - 1.0, size - 1.0)
        for t in range(end - begin):
            m = active[begin + t]
            x = here[t, :m]
            guessed, begins = model.predict(places[t, :, :m])
            right = guessed == x
            by_one, by_two = right.view(np.int8)
            rest = by_one | by_two
            rest ^= 1
            which = plain[t, :m] * rest
            which += (by_one > by_two).view(np.int8)
            which, rest = which.astype(np.int64), rest.astype(float)
            start, wide = _taken(begins, which, np.floor(width[:m] * 0.5**SHARES))
            whole = wholes[t, :m] * rest
            whole += 1
            part = np.floor(wide / whole)
            inner = starts[t, :m] * rest
            inner *= part
            start += inner
            low[:m] += start
            share = shares[t, :m] * rest
            share += 1
            part *= share
            width[:m] = part
            model.learn(x, right, which)
            now = np.flatnonzero(part < BOTTOM)
            while len(now):
                value, at = low[now], used[now]
                word = np.floor(value * (1 / BOTTOM))
                out[at] = word.astype(np.uint32)
                used[now] = at + 1
                word *= BOTTOM
                value -= word
                value *= WORD
                low[now] = value
                value = width[now] * WORD
                width[now] = value
                now = now[value < BOTTOM]
    low, used = low.astype(np.int64), used - np.arange(b) * room
    out = out.reshape(b, room)
    for k, word in enumerate((low >> 32, low >> 16 & 0xFFFF, low & 0xFFFF)):
        out[np.arange(b), used + k] = word
    return [_carried(out[k, :n]) for k, n in enumerate((used + 3).tolist())]


def _carried(words: np.ndarray) -> bytes:
    """Words of 16 bits, carries added to the words before."""
    while (over := words >> 16).any():
        words &= 0xFFFF
        words[:-1] += over[1:]
    return words.astype("<u2").tobytes()


def decode(coded: list[bytes], size: int) -> list[np.ndarray]:
    """The ids of coded blocks; a block that was changed raises ValueError."""
    result: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(coded)
    heads = []
    for block in coded:
        if block[:4] != MAGIC or struct.unpack("<I", block[4:8])[0] != zlib.crc32(block[8:]):
            raise ValueError("a block of ids is damaged")
        heads.append(struct.unpack("<II", block[8:16]))
    by_length = sorted(range(len(coded)), key=lambda k: -heads[k][0])
    for low in range(0, len(coded), SIDE_BY_SIDE):
        chosen = by_length[low : low + SIDE_BY_SIDE]
        found = _decode([coded[k][16:] for k in chosen], np.array([heads[k][0] for k in chosen]), size)
        for k, ids in zip(chosen, found, strict=True):
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[k][1]:
                raise ValueError("a block of ids is damaged")
            result[k] = ids
    return result


def _decode(coded: list[bytes], lengths: np.ndarray, size: int) -> list[np.ndarray]:
    b = len(coded)
    ids = np.zeros((lengths.max(initial=0), b), np.uint16 if size <= 1 << 16 else np.int32)
    words = np.zeros((b, max(map(len, coded)) // 2), np.uint16)
    for k, block in enumerate(coded):
        words[k, : len(block) // 2] = np.frombuffer(block, "<u2")
    code = words[:, 0] * 2.0**32 + words[:, 1] * 2.0**16 + words[:, 2]
    used, words = np.arange(b) * words.shape[1] + 3, words.ravel()
    active = _active(lengths).tolist()
    model, width, lanes = Model(b), np.full(b, TOP), np.arange(b)
    one, two = np.zeros((2, b), np.int64)
    packed, run_of = np.zeros(0, np.int64), np.zeros(0, np.int32)
    for begin, end, n in _stretches(len(ids)):
        if n:
            at, many, value = _runs(np.ascontiguousarray(ids[begin - n : begin, : active[begin]].T))
            packed = value << 32 | (at % n) << 16 | many
            run_of = np.repeat(np.arange(len(at), dtype=np.int32), many)  # of each slot of all blocks
        rows = lanes * n
        for t in range(begin, end):
            m = active[t]
            guessed, begins = model.predict(model.places(one[:m], two[:m]))
            part = np.floor(width[:m] * 0.5**SHARES)
            reached = (code[:m] / part).astype(np.int64)
            reached *= _EACH
            reached |= _OVER
            reached -= begins
            reached &= _OVER
            which = np.bitwise_count(reached).astype(np.int64)
            which -= 1
            start, wide = _taken(begins, which, part)
            left = code[:m] - start
            x = np.where(which == TWO, guessed[1], guessed[0])
            old = np.flatnonzero(which == OLD)
            if len(old):
                part, rest = np.floor(wide[old] / n), left[old]
                slot = (rest / part).astype(np.int64)
                slot += rows[old]
                slot = packed.take(run_of.take(slot, mode="clip"), mode="clip")
                x[old] = slot >> 32
                left[old] = rest - (slot >> 16 & 0xFFFF) * part
                wide[old] = (slot & 0xFFFF) * part
            new = np.flatnonzero(which == LITERAL)
            if len(new):
                part, rest = np.floor(wide[new] / size), left[new]
                value = np.floor(rest / part)
                x[new] = value
                left[new] = rest - value * part
                wide[new] = part
            code[:m], width[:m] = left, wide
            ids[t, :m] = x
            model.learn(x, guessed == x, which)
            two, one = one, x.astype(np.int64)
            now = np.flatnonzero(wide < BOTTOM)
            while len(now):
                at = used[now]
                value = code[now] * WORD
                value += words[at]
                code[now] = value
                used[now] = at + 1
                value = width[now] * WORD
                width[now] = value
                now = now[value < BOTTOM]
    ids = np.ascontiguousarray(ids.T)
    return [ids[k, :n].astype(np.uint32) for k, n in enumerate(lengths.tolist())]
