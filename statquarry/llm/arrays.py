"""Whole columns of text as numpy arrays: UTF-8 bytes, words, hashes, window hashes and window minima.

Tasks read Arrow batches.  ``sliced`` cuts them into runs of rows of bounded size, so that memory hangs on the longest
text and not on the number of rows in a batch.  All offsets are byte positions in the buffer of one slice.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 21
PAD = 64
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def sliced(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts together hold ``limit`` bytes at most, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        low, done = 0, 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(low, high - low)
            low, done = high, int(ends[high - 1])


def release() -> None:
    """Give memory that is free back to the machine: a worker lives on after its task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def released(function: Callable) -> Callable:
    """``function`` on a group's rows, with ``release`` after every group."""

    def run(rows):
        out = function(rows)
        del rows
        release()
        return out

    return run


def map_slices(
    df: DataFrame, text: str, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Run ``function`` on every slice of ``df``; it returns a batch of the columns of ``schema``."""

    def run(batches):
        for part in sliced(batches, text, limit):
            out = function(part)
            if out.num_rows:
                yield out
            del part, out
        release()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (a null is empty), followed by ``PAD`` zeros, and the offsets of the texts."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    total = int(offsets[-1] - offsets[0])
    buf = np.zeros(total + PAD, np.uint8)
    if total:
        buf[:total] = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return buf, offsets - offsets[0]


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as a little-endian integer, without copying."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))


_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


def hash_slices(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte run ``buf[start:end]``; equal runs have equal hashes."""
    eight, size = lanes(buf), end - start
    out = mix(size.astype(np.uint64) * M1)
    active, at = np.flatnonzero(size > 0), 0
    while len(active):
        left = np.minimum(size[active] - at, 8)
        out[active] = mix(out[active] ^ (eight[start[active] + at] & _LOW[left])) * M1
        at += 8
        active = active[size[active] > at]
    return out


@dataclass
class Words:
    """Words of all texts of a slice: byte range, number of its text, and the range of word numbers of each text."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more entry than there are texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def split_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of bytes other than blank and 0x09-0x0D, within each text.  These bytes never are part of a longer character."""
    total = int(offsets[-1])
    body = buf[:total]
    space = (body == 32) | ((body - np.uint8(9)) < 5)
    # a word starts at a non-space after a space or at a text's start; it ends likewise
    edge = np.ones(total + 1, bool)
    if total:
        edge[1:total] = space[:-1]
        edge[offsets[:-1][offsets[:-1] < total]] = True
    start = np.flatnonzero(edge[:total] & ~space)
    last = np.ones(total, bool)
    if total:
        last[:-1] = space[1:]
        inner = offsets[1:-1]
        last[inner[(inner > 0)] - 1] = True
    end = np.flatnonzero(last & ~space) + 1
    return Words(start, end, np.searchsorted(start, offsets))


_POWERS: dict[str, np.ndarray] = {}
_BASE, _INVERSE = np.uint64(0xD6E8FEB86659FD93), np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.cumprod(table, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Rolling:
    """Hash of any run of values in constant time, from the prefix sums of a polynomial modulo 2^64.

    The values must be spread over 64 bits already (``mix`` or ``hash_slices``): then two different runs have equal
    hashes with a chance near 2^-64.
    """

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(((self.sums[end] - self.sums[start]) * self.down[start]) ^ ((end - start).astype(np.uint64) * M1))

    def windows(self, size: int) -> np.ndarray:
        """Hash of every run of ``size`` values, by its start."""
        n = max(0, len(self.sums) - size)
        return mix(((self.sums[size:] - self.sums[:n]) * self.down[:n]) ^ np.uint64(size * int(M1) % (1 << 64)))


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """For every run of ``size`` values the place of the least one, the leftmost of equals."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[size - 1 : size - 1 + n])
    # the place: the last value equal to the minimum of a window, searched from each place where the minimum is attained
    place = np.empty(n, np.int64)
    hit = behind[:n] == least
    own = np.arange(len(padded)).reshape(blocks, size)
    leftmost = _leftmost(grid, own)
    place[hit] = leftmost[:n][hit]
    rest = np.flatnonzero(~hit)
    place[rest] = _first_equal(grid, own)[rest + size - 1]
    return place


def _leftmost(grid: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For every cell the place of the leftmost least value from it to its row's end."""
    back = grid[:, ::-1]
    least = np.minimum.accumulate(back, axis=1)
    mark = np.where(back == least, own[:, ::-1], np.iinfo(np.int64).max)
    # walking back, every value that equals the least so far is further left
    out = np.minimum.accumulate(mark, axis=1)
    return out[:, ::-1].ravel()


def _first_equal(grid: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For every cell the place of the leftmost least value from its row's start to it."""
    least = np.minimum.accumulate(grid, axis=1)
    fresh = np.ones(grid.shape, bool)
    fresh[:, 1:] = grid[:, 1:] < least[:, :-1]
    return np.maximum.accumulate(np.where(fresh, own, 0), axis=1).ravel()


def join_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of every text joined by one blank: bytes (with padding) and offsets.  ``first`` ranges over the given words."""
    size = end - start + 1
    last = first[1:][np.diff(first) > 0] - 1
    size[last] -= 1
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    out = np.zeros(total + PAD, np.uint8)
    out[:total] = buf[np.repeat(start - (stop - size), size) + np.arange(total)]
    gap = np.ones(len(start), bool)
    gap[last] = False
    out[stop[gap] - 1] = 32
    return out, np.append(0, stop)[first]


def as_binary(buf: np.ndarray, offsets: np.ndarray, text: bool = False) -> pa.Array:
    """Column of the byte runs between ``offsets``."""
    kind = pa.large_string() if text else pa.large_binary()
    column = pa.Array.from_buffers(
        kind, len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buf[: int(offsets[-1])])]
    )
    return column.cast(pa.string() if text else pa.binary())


def ranges(marked: np.ndarray, first: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Maximal marked runs of units inside every text, as a column of (start, end) lists and as their numbers."""
    sizes = np.diff(first)
    begin, stop = marked.copy(), marked.copy()
    begin[1:] &= ~marked[:-1]
    stop[:-1] &= ~marked[1:]
    inner = first[:-1][sizes > 0]
    begin[inner] |= marked[inner]
    stop[first[1:][sizes > 0] - 1] |= marked[first[1:][sizes > 0] - 1]
    low, high = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    offsets = np.searchsorted(low, first)
    base = np.repeat(first[:-1], np.diff(offsets))
    pairs = pa.StructArray.from_arrays([pa.array(low - base), pa.array(high - base)], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs), np.diff(offsets)
