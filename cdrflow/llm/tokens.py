"""Vectorised words and word hashes over Arrow batches of text.

A batch is cut into slices of at most ``SLICE_BYTES`` (a longer text is a
slice of its own), so the numpy temporaries of a task stay bounded whatever
the Arrow batch size. All work is on UTF-8 bytes: the word classes below
treat every byte >= 0x80 as a word byte, which is what they say of the
characters those bytes belong to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words are runs of everything but blank characters.
BLANK_SPLIT = np.ones(256, dtype=bool)
BLANK_SPLIT[[0x20, *range(0x09, 0x0E)]] = False
#: Words are runs of digits, lower-case letters and non-ASCII characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n; kept between calls."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        made = []
        for b in (BASE, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def cut(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes each, or one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


@dataclass
class Words:
    """Words of consecutive texts: text d has words[offsets[d]:offsets[d + 1]]."""

    text: np.ndarray      # lower-cased bytes of the slice
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray    # first byte of each text, and the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.text))
        sums = np.zeros(len(self.text) + 1, np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def word(self, i: int) -> bytes:
        return self.text[self.starts[i]: self.ends[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``, A-Z lower-cased
    unless ``fold`` maps bytes in another way."""
    base = offsets[0]
    bounds = offsets - base
    text = fold[data[base: offsets[-1]]]
    inside = word_byte[text]
    if not len(text):
        none = np.zeros(0, np.int64)
        return Words(text, none, none, np.zeros(len(bounds), np.int64), bounds)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[heads] = inside[heads]
    tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return Words(text, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds), bounds)


def slices(column: pa.Array, word_byte: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, row behind, words) for bounded slices of a text column."""
    data, offsets = raw(column)
    for at, to in cut(offsets):
        yield at, to, words_of(data, offsets[at: to + 1], word_byte)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive hashes (k > 0; empty when there are fewer)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            total += hashes[j: j + n] * factor
            factor = factor * STEP
    return mix(total)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each word its text's number."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
