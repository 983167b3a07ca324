"""Hashes of the words and word windows of Arrow text columns, in numpy.

Words are runs of bytes other than white space (0x20, 0x09-0x0D); UTF-8 keeps
these bytes to themselves, so the work is on the column's bytes: a prefix sum
of random byte weights times powers of an odd base gives every word's
polynomial hash at once. Texts are taken in blocks of ``BLOCK`` bytes, so the
memory needed does not follow the batch, and a text longer than that is cut
at white space into pieces of that size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U64 = np.uint64
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shifts and odd multipliers)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Hasher:
    """Word hashes under one random byte table and base."""

    def __init__(self, seed: int, lower: bool):
        rng = np.random.default_rng(seed)
        self.weights = rng.integers(1, 2 ** 63, 256, dtype=U64) * U64(2) + U64(1)
        if lower:
            self.weights[0x41:0x5B] = self.weights[0x61:0x7B]
        base = int(rng.integers(1, 2 ** 61)) * 8 + 5
        self.up = powers(base, BLOCK + 1)
        self.down = powers(pow(base, -1, 2 ** 64), BLOCK + 1)
        self.step = U64(int(rng.integers(1, 2 ** 61)) * 8 + 3)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.empty(len(data) + 1, U64)
        sums[0] = 0
        np.cumsum(self.weights[data] * self.up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.down[starts])

    def windows(self, words: np.ndarray, n: int) -> np.ndarray:
        """The hash of each n consecutive values (len(words) - n + 1 of them)."""
        count = len(words) - n + 1
        if count <= 0:
            return np.empty(0, U64)
        out = words[:count].copy()
        for k in range(1, n):
            out *= self.step
            out += words[k:k + count]
        return mix(out)


_HASHERS: dict[bool, tuple[Hasher, Hasher]] = {}


def hashers(lower: bool) -> tuple[Hasher, Hasher]:
    """Two independent hashers, the same in every process."""
    if lower not in _HASHERS:
        _HASHERS[lower] = (Hasher(11, lower), Hasher(12, lower))
    return _HASHERS[lower]


@dataclass(slots=True)
class Words:
    """The words of some consecutive rows: per row its word count, per word two hashes and its bytes."""

    first_row: int
    counts: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]
    starts: np.ndarray  # byte offsets in the column's data
    ends: np.ndarray


def bounds(data: np.ndarray, breaks: np.ndarray, is_space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word starts and ends in ``data``; no word goes over a break."""
    space = is_space[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = before[-1] = True
    before[1:-1] = space[:-1]
    after = np.empty(len(data) + 1, bool)
    after[-1] = True
    after[:-1] = space
    cut = np.zeros(len(data) + 1, bool)
    cut[breaks] = True
    word = ~space
    starts = np.flatnonzero(word & (before[:-1] | cut[:-1]))
    ends = np.flatnonzero(word & (after[1:] | cut[1:])) + 1
    return starts, ends


def hash_block(data: np.ndarray, breaks: np.ndarray, lower: bool, is_space: np.ndarray = IS_SPACE):
    starts, ends = bounds(data, breaks, is_space)
    return starts, ends, tuple(h.words(data, starts, ends) for h in hashers(lower))


def long_text(data: np.ndarray, lower: bool, is_space: np.ndarray = IS_SPACE):
    """As hash_block, for one text of any length; only a word longer than a block is hashed by parts."""
    parts, at, carry = [], 0, False
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        if stop < len(data):
            gaps = np.flatnonzero(is_space[data[at:stop]])
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
        starts, ends, hashes = hash_block(data[at:stop], np.array([0]), lower, is_space)
        joins = carry and len(starts) and starts[0] == 0
        carry = bool(len(ends)) and ends[-1] == stop - at and stop < len(data)
        if joins:  # the word goes on from the part before
            s, e, h = parts[-1]
            e[-1] = at + ends[0]
            for a, b in zip(h, hashes):
                a[-1] = mix(a[-1:] * U64(0x9E3779B97F4A7C15) + b[:1])[0]
            starts, ends, hashes = starts[1:], ends[1:], tuple(b[1:] for b in hashes)
            if len(starts):
                parts.append((starts + at, ends + at, hashes))
        else:
            parts.append((starts + at, ends + at, hashes))
        parts = [p for p in parts if len(p[0])] or parts[:1]
        at = stop
    if not parts:
        empty = np.empty(0, np.int64)
        return empty, empty, (np.empty(0, U64), np.empty(0, U64))
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            tuple(np.concatenate([p[2][k] for p in parts]) for k in (0, 1)))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row offsets, bytes) of a string column (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)


def column_words(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The words of a string column, block by block, all rows in order (null: no words)."""
    return byte_words(*column_bytes(column), lower)


def byte_words(offsets: np.ndarray, data: np.ndarray, lower: bool = False, is_space: np.ndarray = IS_SPACE) -> Iterator[Words]:
    """As ``column_words``, words being runs of bytes that are not ``is_space``."""
    n, row = len(offsets) - 1, 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        last = min(last, n)
        lo, hi = int(offsets[row]), int(offsets[last])
        if hi - lo > BLOCK:
            starts, ends, hashes = long_text(data[lo:hi], lower, is_space)
        else:
            starts, ends, hashes = hash_block(data[lo:hi], offsets[row:last] - lo, lower, is_space)
        edges = np.searchsorted(starts, offsets[row:last + 1] - lo)
        yield Words(row, np.diff(edges), hashes, starts + lo, ends + lo)
        row = last


def window_hashes(words: Words, n: int, lower: bool = False):
    """(two hashes, row, position) of every window of ``n`` words inside a row."""
    row_of = np.repeat(np.arange(len(words.counts)), words.counts)
    first = np.cumsum(words.counts) - words.counts
    count = max(0, len(row_of) - n + 1)
    inside = row_of[:count] == row_of[n - 1:] if count else np.empty(0, bool)
    rows = row_of[:count][inside]
    at = np.flatnonzero(inside)
    pair = tuple(h.windows(w, n)[inside] for h, w in zip(hashers(lower), words.hashes))
    return pair, rows, at - first[rows]
