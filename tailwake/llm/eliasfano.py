"""Elias-Fano sequences and an n-gram trie made of them, as flat arrays in one file.

A rising sequence of n numbers below u keeps the lower log2(u / n) bits of each as they are and the
upper bits in unary: n ones among the zeros that count the upper part. That is about
2 + log2(u / n) bits a number, and the place of a number is found with a few reads. Everything works
on whole arrays of questions.
"""

from __future__ import annotations

import struct
from pathlib import Path

import numpy as np

_BYTE = np.arange(256, dtype=np.uint8)
_ONES = np.bitwise_count(_BYTE)
#: Place of the k-th one in a byte.
_PLACE = np.zeros((256, 8), np.int64)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _PLACE[_b, : len(_at)] = _at


class EliasFano:
    """A non-decreasing sequence of unsigned numbers."""

    HEAD = struct.Struct("<QQQ")

    def __init__(self, count: int, width: int, low: np.ndarray, high: np.ndarray):
        self.count, self.width, self.low, self.high = count, width, low, high
        # Eight bytes from every place of the lower bits, without a copy.
        self._eights = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        self._ranks: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64, copy=False)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (top // n).bit_length() - 1)) if n else 0
        while top >> width > 4 * n + 64:  # never more than a few bits a number in unary
            width += 1
        low = np.zeros((n * width + 7) // 8 + 8, np.uint8)
        if width and n:
            step = 1 << 16
            for at in range(0, n, step):
                part = values[at : at + step, None] >> np.arange(width, dtype=np.uint64)
                bits = np.packbits((part & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little")
                begin = at * width // 8
                low[begin : begin + len(bits)] = bits
        upper = (values >> np.uint64(width)).astype(np.int64)
        bits = np.zeros((n + (top >> width) + 1 + 63) // 64 * 64, np.uint8)
        bits[upper + np.arange(n)] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = self.HEAD.pack(self.count, self.width, len(self.low))
        return head + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_buffer(cls, data) -> EliasFano:
        """Reads what ``to_bytes`` wrote, in place: from bytes or a memory-mapped file."""
        data = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        count, width, low = cls.HEAD.unpack(data[: cls.HEAD.size].tobytes())
        at = cls.HEAD.size
        return cls(count, width, data[at : at + low], data[at + low :])

    # Bits: ones before each byte, then a table for the place within it.

    def _rank_table(self) -> np.ndarray:
        if self._ranks is None:
            self._ranks = np.zeros(len(self.high) + 1, np.int64)
            np.cumsum(_ONES[self.high], out=self._ranks[1:])
        return self._ranks

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one (or zero) bit, from 0; k must exist."""
        ranks = self._rank_table()
        before = ranks if ones else 8 * np.arange(len(ranks)) - ranks
        at = np.searchsorted(before, k, side="right") - 1
        byte = self.high[at]
        return at * 8 + _PLACE[byte if ones else 255 - byte, k - before[at]]

    def _lower(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        bit = i * self.width
        raw = self._eights[bit >> 3] >> (bit & 7).astype(np.uint64)
        return raw & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        upper = (self._select(i, True) - i).astype(np.uint64)
        return upper << np.uint64(self.width) | self._lower(i)

    def all(self) -> np.ndarray:
        i = np.arange(self.count)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return (ones - i).astype(np.uint64) << np.uint64(self.width) | self._lower(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first number of at least x; ``count`` if there is none."""
        if not self.count:
            return np.zeros(len(x), np.int64)
        x = x.astype(np.uint64, copy=False)
        upper = (x >> np.uint64(self.width)).astype(np.int64)
        zeros = len(self.high) * 8 - self.count
        inside = upper < zeros
        safe = np.where(inside, upper, 0)
        start = np.where(safe > 0, self._select(np.maximum(safe - 1, 0), False) - safe + 1, 0)
        stop = self._select(safe, False) - safe
        at = np.where(inside, start, self.count)
        stop = np.where(inside, stop, self.count)
        target = x & np.uint64((1 << self.width) - 1)
        going = np.flatnonzero(at < stop)
        while len(going):  # halve the range of numbers with the same upper bits
            middle = (at[going] + stop[going]) >> 1
            behind = self._lower(middle) < target[going]
            at[going[behind]] = middle[behind] + 1
            stop[going[~behind]] = middle[~behind]
            going = going[at[going] < stop[going]]
        return at


class Trie:
    """One level of an n-gram trie, in one memory-mapped file: contexts, the words that follow them, and
    two one-byte codes a node, of its probability and of its weight as a context.

    Contexts and words are numbers of nodes of the levels above. Pointers, a rising sequence, give the
    range of each context's followers. These are kept as one sequence: the place of the context stands
    above each word, which makes it rise as a whole. A question finds its context by a successor
    search, then its word by a successor search relative to that context. The place of a follower is
    its node's number, by which the next level names it.
    """

    WORD_BITS = 24
    HEAD = struct.Struct("<QQQQQQ")

    def __init__(self, data: np.ndarray):
        self.word_bits, *sizes = self.HEAD.unpack(data[: self.HEAD.size].tobytes())
        parts, at = [], self.HEAD.size
        for size in sizes:
            parts.append(data[at : at + size])
            at += size
        self.contexts, self.pointers, self.words = map(EliasFano.from_buffer, parts[:3])
        self.codes, self.weights = parts[3:]

    @classmethod
    def write(
        cls,
        path: Path,
        keys: np.ndarray,
        codes: np.ndarray,
        word_bits: int = WORD_BITS,
        weights: np.ndarray | None = None,
    ) -> None:
        """``keys``: distinct and rising, the context above ``word_bits`` bits of word."""
        shift = np.uint64(word_bits)
        context = keys >> shift
        starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(keys) else np.empty(0, int)
        number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(keys)]))
        word = keys & np.uint64((1 << word_bits) - 1)
        levels = (
            EliasFano.of(context[starts]),
            EliasFano.of(np.r_[starts, len(keys)]),
            EliasFano.of(number.astype(np.uint64) << shift | word),
        )
        weights = np.zeros(len(codes), np.uint8) if weights is None else weights
        parts = [level.to_bytes() for level in levels]
        parts += [values.astype(np.uint8).tobytes() for values in (codes, weights)]
        with open(path, "wb") as file:
            file.write(cls.HEAD.pack(word_bits, *map(len, parts)))
            for part in parts:
                file.write(part)

    @classmethod
    def open(cls, path: Path) -> Trie:
        return cls(np.asarray(np.memmap(path, np.uint8, mode="r")))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The node of each key, -1 where it is missing."""
        out = np.full(len(keys), -1, np.int64)
        if not self.contexts.count or not len(keys):
            return out
        shift = np.uint64(self.word_bits)
        context, word = keys >> shift, keys & np.uint64((1 << self.word_bits) - 1)
        # One search for each context, which comes in runs.
        heads = np.r_[True, context[1:] != context[:-1]]
        asked, back = context[heads], np.cumsum(heads) - 1
        number = self.contexts.successor(asked)
        known = number < self.contexts.count
        known[known] = self.contexts.get(number[known]) == asked[known]
        stop = np.zeros(len(asked), np.int64)
        stop[known] = self.pointers.get(number[known] + 1).astype(np.int64)
        rows = np.flatnonzero(known[back])
        target = number[back[rows]].astype(np.uint64) << shift | word[rows]
        place = self.words.successor(target)
        inside = place < stop[back[rows]]
        rows, target, place = rows[inside], target[inside], place[inside]
        same = self.words.get(place) == target
        out[rows[same]] = place[same]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Code of each key, 0 where it is missing."""
        place = self.places(keys)
        out = np.zeros(len(keys), np.uint8)
        out[place >= 0] = self.codes[place[place >= 0]]
        return out
