"""UTF-8 buffers of Arrow columns, words in them and their 64-bit hashes, all by numpy.

A text is never copied into Python objects: words are pairs of byte positions, and a word's hash is a
difference of prefix sums, so a whole batch is hashed by a few array operations. Hashes stand for words
and shingles below; two different ones collide with a probability near 2**-64 for a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at once; bounds the temporary arrays.
CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64; spreads every bit of `x` over the result."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold_table() -> np.ndarray:
    """Byte to byte: A-Z become a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


FOLD = fold_table()
#: Byte classes of the two kinds of words, after folding.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)[FOLD]
_BASE = 0xD1342543DE82EF95  # odd, so that it has an inverse modulo 2**64
_powers: dict[str, np.ndarray] = {}


def _power_table(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base, or of its inverse."""
    table = _powers.get(kind)
    if table is None or len(table) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, CHUNK + 1), base, np.uint64)
        steps[0] = 1
        table = _powers[kind] = np.multiply.accumulate(steps)
    return table[:n]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and the offsets of each; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def groups(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of texts [i, j) of at most `limit` bytes together; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values: of 64-bit hashes many times faster than `np.unique`, which makes a hash table."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the texts at `offsets`, and the number of words before each text."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = np.zeros(hi - lo + 1, bool)
    np.take(is_word, data[lo:hi], out=inside[:-1])
    cut = np.unique(offsets[1:-1]) - lo
    cut = cut[(cut > 0) & (cut < hi - lo)]
    starts = inside[:-1].copy()
    starts[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    if len(cut):
        starts[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(starts) + lo
    return starts, np.flatnonzero(ends) + lo + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word [start, end) with A-Z folded."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        span = data[base:ends[j - 1]]
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(_VALUES[span] * _power_table("up", len(span)), out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * _power_table("down", len(span))[a]
        i = j
    return mix(out)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; position i stands for words i to i + k - 1."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, k * int(_ODD) % (1 << 64), np.uint64)
    for j in range(k):
        total += words[j:j + n] * _power_table("up", k + 2)[j + 1]
    return mix(total)


def folded(data: np.ndarray, start: int, end: int) -> bytes:
    return FOLD[data[start:end]].tobytes()
