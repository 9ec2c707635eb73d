"""Words and word hashes of whole texts, a slice of documents at a time, in numpy.

Texts come as Arrow arrays. A slice holds whole documents of a few megabytes together (a longer document
is a slice of its own), so that a task's memory does not depend on how many rows a batch has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Longer byte strings are hashed one by one, by a cryptographic function.
LONG = 256
_START, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_TAILS = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, true in the given ranges (ends included)."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_set((9, 13), (32, 32))
ASCII_ALNUM_OR_BEYOND = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


class Texts:
    """The bytes of some documents, one after the other, and where each begins; null counts as empty."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        column = column.cast(pa.large_string())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data, self.bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]

    def __len__(self) -> int:
        return len(self.bounds) - 1


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch whose texts have `most` bytes together, or one row each if longer."""
    if not batch.num_rows:
        return
    texts = batch.column(column)
    ends = Texts(texts).bounds
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        part = batch.slice(first, last - first)
        yield part, Texts(part.column(column))
        first = last


def spans(texts: Texts, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each document's first word (one more at the end).

    A word is a maximal run of bytes of the table `inside`; it never reaches over a document's end.
    """
    mask = inside[texts.data]
    edges = texts.bounds[1:-1]
    edges = edges[edges < len(mask)]
    before = np.empty_like(mask)
    before[:1] = False
    before[1:] = mask[:-1]
    before[edges] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty_like(mask)
    after[-1:] = False
    after[:-1] = mask[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, texts.bounds)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end]; A-Z count as a-z if `lower`.

    Eight bytes at a time are mixed into a running hash, so that no sum or power structure of the bytes survives.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = LOWER[data] if lower else data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lengths = (ends - starts).astype(np.int64)
    out = mixed(lengths.astype(np.uint64) * _STEP + _START)
    rows = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    at, left = starts[rows], lengths[rows]
    while len(rows):
        chunk = eight[at]
        short = left < 8
        chunk[short] &= _TAILS[left[short]]
        out[rows] = mixed((out[rows] ^ chunk) * _STEP + _START)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(lengths > LONG).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(padded[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def equal_ranges(one: np.ndarray, at: np.ndarray, two: np.ndarray, to: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether one[at:at+length] equals two[to:to+length], for each of the given ranges."""
    out = np.ones(len(lengths), bool)
    for k in np.flatnonzero(lengths > LONG).tolist():
        out[k] = np.array_equal(one[at[k] : at[k] + lengths[k]], two[to[k] : to[k] + lengths[k]])
    rows = np.flatnonzero((lengths > 0) & (lengths <= LONG))
    views = []
    for data in (one, two):
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[: len(data)] = data
        views.append(np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,)))
    at, to, left = at[rows], to[rows], lengths[rows]
    while len(rows):
        differ = views[0][at] ^ views[1][to]
        short = left < 8
        differ[short] &= _TAILS[left[short]]
        out[rows[differ != 0]] = False
        more = left > 8
        rows, at, to, left = rows[more], at[more] + 8, to[more] + 8, left[more] - 8
    return out


def hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that `hashes` gives these byte strings."""
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    return hashes(np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each of the given ranges, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
