"""Words and pieces of many texts at once: their places and hashes, by numpy over the texts' bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: The bytes that separate words.
SPACES = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multipliers of the two hashes, their inverses modulo 2**64, and the final mixer.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_INVERSES = tuple(np.uint64(pow(int(p), -1, 1 << 64)) for p in _BASES)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in _BASES]


class Spans(NamedTuple):
    """Byte ranges, and which of them each text has: those from first[i] to first[i + 1]."""

    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings without nulls; where each text begins, and the last ends."""
    _, edges, data = column.buffers()
    kind = "<i8" if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else "<i4"
    bounds = np.frombuffer(edges, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if edges else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def parts(column: pa.Array, most: int = 1 << 19, rows: int = 4000) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """A column's texts in slices of about ``most`` bytes: the rows, their bytes and bounds. Texts stay whole."""
    raw, bounds = text_bytes(column)
    i = 0
    while i < len(column):
        j = min(len(column), i + rows, max(i + 1, int(np.searchsorted(bounds, bounds[i] + most, "right")) - 1))
        yield slice(i, j), raw[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


def binary(raw: bytes, bounds: np.ndarray) -> pa.Array:
    """A column of byte strings that lie one behind the other."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype("<i4").tobytes()), pa.py_buffer(raw)])


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[raw]


def spans_of(inside: np.ndarray, bounds: np.ndarray) -> Spans:
    """The runs of bytes that are ``inside``; none crosses a text's bounds."""
    edge = np.empty(len(inside) + 1, bool)
    edge[:-1], edge[-1] = inside, False
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(inside))]
    cuts = cuts[inside[cuts]]  # a text that begins inside
    begins[cuts] = True
    stops = inside & ~edge[1:]
    joined = cuts[inside[cuts - 1]] - 1
    stops[joined] = True
    starts = np.flatnonzero(begins)
    return Spans(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, bounds))


def words(raw: np.ndarray, bounds: np.ndarray) -> Spans:
    """The words between ASCII white space."""
    return spans_of(~SPACES[raw], bounds)


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, n at least; kept for the next call unless they are very many."""
    if len(_powers[which][0]) >= n:
        return _powers[which]
    made = []
    for x in (_BASES[which], _INVERSES[which]):
        out = np.full(n, x, np.uint64)
        out[0] = 1
        made.append(np.cumprod(out, out=out))
    if n <= 1 << 20:
        _powers[which] = (made[0], made[1])
    return made[0], made[1]


def span_hashes(values: np.ndarray, s: Spans, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the values (bytes, or numbers) of each range: equal ranges have equal ones wherever they stand."""
    if not len(s.starts):
        return np.zeros(0, np.uint64)
    up, down = _power(which, len(values) + 1)
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.multiply(values, up[: len(values)], out=sums[1:], dtype=np.uint64)
    sums[1:] += up[: len(values)]  # as if each value were one more: zeros count
    np.cumsum(sums, out=sums)
    found = (sums[s.stops] - sums[s.starts]) * down[s.starts]
    found ^= found >> np.uint64(31)
    found *= _MIX
    found ^= found >> np.uint64(29)
    return found


def wide_hashes(raw: np.ndarray, s: Spans) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each range of bytes. Long ones get a cryptographic hash: sums of powers modulo 2**64 repeat for some."""
    a, b = span_hashes(raw, s), span_hashes(raw, s, 1)
    for i in np.flatnonzero(s.stops - s.starts >= 1000).tolist():
        a[i], b[i] = np.frombuffer(hashlib.blake2b(raw[s.starts[i] : s.stops[i]].tobytes(), digest_size=16).digest(), np.uint64)
    return a, b


class HashTable:
    """Numbers 0, 1, 2 ... for pairs of 64-bit hashes, by open addressing in numpy arrays."""

    def __init__(self, room: int = 1 << 12):
        self.size = 0
        self._grow(room)

    def _grow(self, room: int) -> None:
        bits = max(12, int(2 * room - 1).bit_length())
        old = None if not self.size else (self.a, self.b, self.number)
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.a, self.b, self.number = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        if old is not None:
            used = np.flatnonzero(old[2] >= 0)
            self._put(old[0][used], old[1][used], old[2][used])

    def _put(self, a: np.ndarray, b: np.ndarray, number: np.ndarray) -> None:
        slot, left = (a >> self.shift).astype(np.int64), np.arange(len(a))
        while len(left):
            free = self.number[slot[left]] < 0
            at = left[free]
            self.number[slot[at]] = number[at]  # of those that want the same slot the last has it
            won = at[self.number[slot[at]] == number[at]]
            self.a[slot[won]], self.b[slot[won]] = a[won], b[won]
            left = left[self.number[slot[left]] != number[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair; -1 for one not held."""
        slot = (a >> self.shift).astype(np.int64)
        out = self.number[slot]
        left = np.flatnonzero((out >= 0) & ((self.a[slot] != a) | (self.b[slot] != b)))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            here = slot[left]
            out[left] = self.number[here]
            left = left[(out[left] >= 0) & ((self.a[here] != a[left]) | (self.b[here] != b[left]))]
        return out

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """New, distinct pairs: they get the next numbers in turn."""
        if 2 * (self.size + len(a)) > self.mask:
            self._grow(2 * (self.size + len(a)))
        self._put(a, b, np.arange(self.size, self.size + len(a), dtype=np.int32))
        self.size += len(a)


def distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each distinct pair, and how often it occurs."""
    order = np.argsort(a)
    x, y = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    if ((x[1:] == x[:-1]) & new[1:]).any():  # two words with one first hash: order by both
        order = np.lexsort((b, a))
        x, y = a[order], b[order]
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    begin = np.flatnonzero(new)
    return order[begin], np.diff(begin, append=len(a))
