"""Whole Arrow text columns as arrays of word hashes, without Python strings.

A word is a maximal run of bytes outside ASCII white space
(``[^\\x20\\x09-\\x0D]+``). A column is read in slices of about a megabyte, so
memory does not grow with the batch, only with its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1024

_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_M_INV = np.uint64(pow(int(_M), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (xor-shift and multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: np.uint64, inverse: np.uint64):
        self.base, self.inverse = base, inverse
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            up, down = np.full(size, self.base), np.full(size, self.inverse)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_BYTES = _Powers(_M, _M_INV)
_C = np.uint64(0xD6E8FEB86659FD93)
_WORDS = _Powers(_C, np.uint64(pow(int(_C), -1, 1 << 64)))


@dataclass
class Words:
    """Words of several texts: ``hashes[first[i]:first[i + 1]]`` are those of text i."""

    hashes: np.ndarray
    first: np.ndarray
    lengths: np.ndarray  # bytes of each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column (null: empty) and the offsets of its texts."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    offsets = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``SLICE_BYTES`` of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.diff(buffers(batch.column(text))[1]))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, base + SLICE_BYTES, "right"))
            to = min(max(to, at + 1), at + SLICE_ROWS, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def words_of(col: pa.Array, lower: bool, plain: bool = False) -> Words:
    """Hashes of the words of each text; ``lower`` folds A-Z only.

    With ``plain`` every ASCII character that is no letter or digit separates
    words, not only white space.
    """
    data, offsets = buffers(col)
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64))
    white = PLAIN[data] if plain else (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = white[:-1]
    starts = np.flatnonzero(~white & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = white[1:]
    ends = np.flatnonzero(~white & (after | edge[1:])) + 1
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    up, down = _BYTES.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, np.searchsorted(starts, offsets), ends - starts)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words (texts are not told apart)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.get(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[:n - size + 1])


def window_starts(words: Words, size: int) -> np.ndarray:
    """Indexes of the words at which a run of ``size`` words of one text starts."""
    n = len(words.hashes)
    if n < size:
        return np.zeros(0, np.int64)
    last = np.repeat(words.first[1:], words.counts)  # end of the text of each word
    at = np.arange(n)
    return at[at + size <= last]


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and where each text's set starts.

    A shingle is ``size`` consecutive words; a text with fewer words has its
    whole sequence as one; a text without words has none. Values are 54 bits,
    ordered by text, so one sort does for all texts of a slice.
    """
    n_docs = len(words.first) - 1
    counts = words.counts
    starts = window_starts(words, size)
    values = window_hashes(words.hashes, size)[starts] if len(starts) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n_docs), np.maximum(counts - size + 1, 0))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [window_hashes(words.hashes[words.first[i]:words.first[i + 1]], int(counts[i]))[0] + np.uint64(counts[i])
                 for i in short]
        values = np.concatenate([values, np.array(whole, np.uint64)])
        owner = np.concatenate([owner, short])
    if n_docs > SLICE_ROWS:
        raise ValueError(f"at most {SLICE_ROWS} texts in a slice")
    key = (owner.astype(np.uint64) << np.uint64(54)) | (values >> np.uint64(10))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    first = np.searchsorted(key, np.arange(n_docs + 1, dtype=np.uint64) << np.uint64(54)) if n_docs < 1024 else \
        np.concatenate([np.searchsorted(key, np.arange(n_docs, dtype=np.uint64) << np.uint64(54)), [len(key)]])
    return key & np.uint64((1 << 54) - 1), first
