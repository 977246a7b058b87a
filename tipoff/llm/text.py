"""Whole columns of text as byte arrays: word spans and hashes without a loop over words.

Tasks get Arrow batches. :func:`slices` cuts them into pieces of bounded size, each one
UTF-8 byte array with the offsets of its rows; spans and hashes are array operations on it.
Hashes are polynomial over a table of random 64-bit values per byte, modulo 2**64, so the
hash of any span follows from two prefix sums.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text a task holds as arrays at once; one longer row makes a slice of its own.
SLICE_BYTES = 1 << 20
MAX_ID = np.iinfo(np.int64).max

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class _Tables:
    """Powers of the base and of its inverse, grown on demand, and the byte table."""

    up = _powers(_BASE, 1)
    down = _powers(_INVERSE, 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def _byte_values(lower: bool) -> np.ndarray:
    table = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 63, 256, dtype=np.uint64)
    table = table * np.uint64(2) + np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    return table


VALUES, VALUES_LOWER = _byte_values(False), _byte_values(True)


def _byte_set(outside: Iterable[int]) -> np.ndarray:
    inside = np.ones(256, bool)
    inside[list(outside)] = False
    return inside


# Words [^\x20\x09-\x0D]+, and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
BLANK_SEPARATED = _byte_set([0x20, *range(0x09, 0x0E)])
LETTERS_DIGITS = _byte_set([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def release() -> None:
    """Give back memory that freed arrays left in a Python worker, which outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, with :func:`release` at the task's end."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return task


def releasing_group(solve: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``solve`` of one group, with :func:`release` after it."""

    def task(table: pa.Table) -> pa.Table:
        found = solve(table)
        release()
        return found

    return task


class Slice(NamedTuple):
    """Some rows of a batch: their first row number, byte offsets and bytes."""

    first: int
    offsets: np.ndarray
    data: np.ndarray

    def row_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array | pa.ChunkedArray, limit: int | None = None) -> Iterator[Slice]:
    """Byte arrays of a string column, ``limit`` bytes (or one row) at a time; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    yield from parts(Slice(0, offsets, data), limit)


def parts(part: Slice, limit: int | None = None) -> Iterator[Slice]:
    """A slice in pieces of ``limit`` bytes (or one row); ``first`` counts within the slice."""
    offsets, n, at = part.offsets, len(part.offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (limit or SLICE_BYTES), "right")) - 1)
        own = offsets[at : end + 1]
        yield Slice(at, own - own[0], part.data[own[0] : own[-1]])
        at = end


def spans(part: Slice, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes in ``inside``; runs end with their row."""
    data, offsets = part.data, part.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = inside[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    filled = offsets[1:] > offsets[:-1]
    begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begins] = word[begins]
    last[ends] = word[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _Tables.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(part: Slice, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; ``lower`` reads A-Z as a-z."""
    return mix(_span_sums((VALUES_LOWER if lower else VALUES)[part.data], starts, ends))


def window_hashes(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of the word sequence ``words[start : start + length]`` of every start."""
    return mix(_span_sums(words, starts, starts + lengths))


def window_starts(rows: np.ndarray, length: int) -> np.ndarray:
    """Positions at which ``length`` consecutive words of one row begin; rows ascend."""
    if len(rows) < length:
        return np.zeros(0, np.int64)
    return np.flatnonzero(rows[length - 1 :] == rows[: len(rows) - length + 1])


def ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An id column as numbers; a null id sorts behind every other one."""
    return batch.column(name).cast(pa.int64()).fill_null(MAX_ID).to_numpy(zero_copy_only=False)
