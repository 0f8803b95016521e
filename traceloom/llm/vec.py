"""Words and word windows of a whole Arrow column at once, as numpy arrays.

A word's hash is a polynomial over its bytes, a window's a polynomial over its
words' hashes, both taken as differences of prefix sums modulo 2**64, so the
cost does not depend on the window length.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
OTHER = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)
CHUNK = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}
_kept: dict[object, object] = {}
_runs: list[tuple[str, str]] = []  # the operator whose tasks this worker runs


def keep(key: object, make: Callable) -> object:
    """What ``make`` returns, held by the Python worker until it begins a task of another operator."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def begin(run: tuple[str, str]) -> None:
    """Drops what the worker keeps for another operator than ``run``."""
    if _runs != [run]:
        _kept.clear()
        _runs[:] = [run]


def tidy(run: Callable) -> Callable:
    """``run``, a function of Arrow batches, which gives its memory back to the system when its task ends.

    Python workers live on between tasks, each with what its allocators hold.
    """
    name = (run.__module__, run.__qualname__)

    @functools.wraps(run)
    def to_the_end(batches):
        begin(name)
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return to_the_end


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    had = _powers.get(base)
    if had is None or len(had) < n:
        step = np.full(max(1 << 12, 1 << (n - 1).bit_length()) if n <= CHUNK else n, base, np.uint64)
        step[0] = 1
        had = np.multiply.accumulate(step)
        if len(had) <= 2 * CHUNK:
            _powers[base] = had
    return had[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rows(batches, step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as Python values, few of them at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, step):
            yield from zip(*(c.slice(lo, step).to_pylist() for c in b.columns))


@dataclass
class Words:
    """Words of rows ``lo`` to ``hi`` of a column. Offsets are in bytes of ``data``."""

    lo: int
    hi: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each row, and the number of words
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def words(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[Words]:
    """Words between white space (bytes 9 to 13 and 32), in chunks of rows of about CHUNK bytes."""
    at, data = binary(column)
    n = len(at) - 1
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + CHUNK, "right")) - 1)
        hi = min(hi, n)
        part = data[at[lo] : at[hi]]
        edges = at[lo : hi + 1] - at[lo]
        if lower:
            part = LOWER[part]
        yield Words(lo, hi, part, *_split(part, edges))
        lo = hi


def _split(part: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if not len(part):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(edges), np.int64), np.zeros(0, np.uint64)
    solid = ~SPACE[part]
    begins = np.ones(len(part) + 1, bool)  # a word may begin here, seen from the byte before
    begins[1:] = ~solid.repeat(1)
    begins[edges] = True
    start = np.flatnonzero(solid & begins[:-1])
    end = np.flatnonzero(solid & np.append(begins[1:-1] | ~solid[1:], True)) + 1
    sums = np.zeros(len(part) + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(part)), out=sums[1:])
    back = powers(INVERSE, len(part))
    h = mix((sums[end] - sums[start]) * back[start] ^ (end - start).astype(np.uint64) << np.uint64(56))
    return start, end, np.searchsorted(start, edges).astype(np.int64), h


def windows(w: Words, size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """(position among the chunk's words, hash) of every window of ``size`` words inside one row. Another odd ``base`` gives another hash."""
    n = len(w.hashes)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hashes * powers(base, n), out=sums[1:])
    h = mix((sums[size:] - sums[:-size]) * powers(pow(base, -1, 1 << 64), n)[: n - size + 1] + np.uint64(size))
    row = np.repeat(np.arange(len(w.first) - 1), w.counts())
    at = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
    return at, h[at]
