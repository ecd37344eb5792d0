"""Words, lines and their fingerprints for many texts at once, on the UTF-8 bytes of Arrow string columns.

A fingerprint of a byte range is the sum, over its bytes, of a scrambled value of the byte and its place in the range, modulo
2**64, scrambled once more with the length. A byte counts otherwise at each place and no place is a multiple of another, so
texts that follow a rule, such as words of two letters that are each other's complement, do not cancel out. All ranges of a
batch are hashed without a Python loop. ``family`` chooses one of several independent hashes. Memory: about 60 bytes for each
byte of the texts handled at once, which are ``STEP_BYTES`` or one longer text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CODES = mixed(np.arange(1, 257, dtype=np.uint64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

FAMILIES = 2
#: of each family: values of the bytes, values of the places as far as they were needed, and an odd factor
_bytes = [mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x51ED270B * (f + 1))) for f in range(FAMILIES)]
_places = [np.zeros(0, np.uint64) for _ in range(FAMILIES)]
_factors = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]


def _place_values(family: int, size: int) -> np.ndarray:
    if len(_places[family]) < size:
        _places[family] = mixed(np.arange(max(size, 1 << 12), dtype=np.uint64) + (np.uint64(family + 1) << np.uint64(48)))
    return _places[family]


class Scan:
    """The texts ``bytes[offsets[i]:offsets[i + 1]]`` and what is found in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = data
        self.offsets = offsets
        self.count = len(offsets) - 1
        self.data = LOWER[data] if lower else data
        word = ~BLANK[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        filled = offsets[:-1] < offsets[1:]
        at, to = offsets[:-1][filled], offsets[1:][filled] - 1
        first[at] = word[at]
        last[to] = word[to]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: of text i: words ``word_at[i]`` up to ``word_at[i + 1]``
        self.word_at = np.searchsorted(self.starts, offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
        """Fingerprints of byte ranges that are not empty and do not overlap, in the order of the text."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        sizes = ends - starts
        begin = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum())
        place = at - np.repeat(begin, sizes)
        values = _bytes[family][self.data[at + np.repeat(starts - begin, sizes)]] ^ _place_values(family, int(sizes.max()))[place]
        values *= _factors[family]
        values ^= values >> np.uint64(29)
        return mixed(np.add.reduceat(values, begin) + sizes.astype(np.uint64) * _factors[family - 1])

    def word_hashes(self, family: int = 0) -> np.ndarray:
        return self.hashes(self.starts, self.ends, family)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.count), np.diff(self.word_at))


def windows(hashes: np.ndarray, word_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (a word number) and fingerprint of every run of ``n`` words that lies within one text."""
    size = max(0, len(hashes) - n + 1)
    rolled = np.zeros(size, np.uint64)
    for k in range(n):
        rolled += hashes[k : k + size] * CODES[k % 256] + np.uint64(k // 256)
    inside = np.ones(size, bool)
    for k in range(1, n):  # no window starts in the last n - 1 words of a text
        near = word_at[1:] - k
        inside[near[(near >= 0) & (near < size)]] = False
    starts = np.flatnonzero(inside)
    return starts, mixed(rolled[starts] + np.uint64(n))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batch: pa.RecordBatch, text: str, size: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``size`` bytes of text each, with bytes and offsets of the text column."""
    if batch.num_rows == 0:
        return
    data, offsets = texts(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def rest() -> None:
    """Give freed memory back to the system at the end of a task; Spark keeps the worker, maybe for long, for later ones."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the GNU library only
        trim(0)
