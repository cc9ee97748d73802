"""Word and shingle hashes of Arrow text columns, computed on whole buffers.

All arithmetic is modulo 2^64.  A word's hash is a polynomial in its bytes, a
window's hash a polynomial in its words' mixed hashes; prefix sums and inverse
powers give every word and every window with a few array operations, without a
Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

# Two independent families: an odd base for bytes and one for words.
FAMILIES = (
    (U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)),
    (U64(0xC2B2AE3D27D4EB4F), U64(0xA0761D6478BD642F)),
)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: U64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), kept for the next call."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            full = np.full(max(n, 2 * SLICE_BYTES), base, dtype=U64)
            full[0] = 1
            have = _powers[int(base)] = np.multiply.accumulate(full)
    return have[:n]


def inverse(base: U64) -> U64:
    return U64(pow(int(base), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finalizer of splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """The words of a slice of documents.

    ``first[i]:first[i + 1]`` are the words of document ``i``; ``start`` and
    ``end`` are their bytes in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~_BLANK[data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        full = offsets[:-1] < offsets[1:]
        head, tail = offsets[:-1][full], offsets[1:][full] - 1
        opens[head] = inside[head]
        closes[tail] = inside[tail]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, family: int = 0) -> np.ndarray:
        base = FAMILIES[family][0]
        n = len(self.data)
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum((self.data.astype(U64) + U64(1)) * powers(base, n), out=total[1:])
        return mix((total[self.end] - total[self.start]) * powers(inverse(base), n + 1)[self.start])

    def windows(self, hashes: np.ndarray, size: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words within a document, and where it starts."""
        base = FAMILIES[family][1]
        n = len(hashes)
        total = np.zeros(n + 1, dtype=U64)
        np.cumsum(hashes * powers(base, n), out=total[1:])
        counts = np.maximum(self.counts - (size - 1), 0)
        at = ranges(self.first[:-1], counts)
        return mix((total[at + size] - total[at]) * powers(inverse(base), n + 1)[at] + U64(size)), at


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, .. for counts[i] values each, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The column in slices of whole documents: rows from, to, bytes, offsets.

    A slice has about ``size`` bytes, or a single longer document.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def word_slices(column: pa.Array, lower: bool) -> Iterator[tuple[int, int, Words]]:
    for row, to, data, offsets in slices(column):
        yield row, to, Words(data, offsets, lower)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted within it, and their bounds.

    A document with fewer words than ``size`` has its whole sequence as its one
    shingle, an empty one none.
    """
    hashes = words.hashes()
    found, at = words.windows(hashes, size)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < size))
    document = np.repeat(np.arange(len(counts)), np.maximum(counts - (size - 1), 0))
    if len(short):
        base = FAMILIES[0][1]
        lone = [
            mix((hashes[words.first[i] : words.first[i + 1]] * powers(base, int(counts[i]))).sum(keepdims=True) + U64(counts[i]))
            for i in short
        ]
        found, document = np.concatenate([found, *lone]), np.concatenate([document, short])
    order = np.lexsort((found, document))
    found, document = found[order], document[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (document[1:] != document[:-1])
    found, document = found[new], document[new]
    return found, np.searchsorted(document, np.arange(len(counts) + 1))


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
