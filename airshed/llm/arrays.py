"""Numpy helpers that run inside tasks: whole Arrow batches of text as byte, word and window arrays.

Every hash is 64-bit. A word's hash is a polynomial over its (case-folded) bytes, taken
from prefix sums, so one pass over the bytes gives all words; a window's hash is a
polynomial over word hashes. Work is done in pieces of a bounded number of bytes.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_B = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_C = U(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
PIECE = 1 << 20  # bytes of text worked on at once; one longer text is a piece of its own

# byte classes of the word rules
SPACE = frozenset([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = frozenset([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])  # after folding A-Z

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.n, self.up, self.down = 0, None, None

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, PIECE + 1)
            self.up = _powers(_B, self.n)
            self.down = _powers(U(pow(int(_B), -1, 1 << 64)), self.n)
        return self.up, self.down


_POW = _Powers()

_KEPT: dict[str, Callable[[], None]] = {}  # what a worker has kept for its stage, and how it goes
_STAGE: list[str] = []


def give_back() -> None:
    """Memory that nothing holds any more goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def enter(stage: str, forget: Callable[[], None] | None = None) -> None:
    """A task of `stage` begins on this worker: what another stage's tasks have kept (a model, a
    cache, long tables of powers) goes. `forget` drops what this stage is going to keep."""
    if _STAGE != [stage]:
        for name in [n for n in _KEPT if n != stage]:
            _KEPT.pop(name)()
        _POW.__init__()
    if _STAGE:  # not the worker's first task: what the one before has freed
        give_back()
    _STAGE[:] = [stage]
    if forget is not None:
        _KEPT[stage] = forget


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them (in place)."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def pieces(column: pa.Array, limit: int = PIECE):
    """(first row, row offsets, bytes) of runs of rows holding about `limit` bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, offsets[lo : hi + 1] - offsets[lo], buf[offsets[lo] : offsets[hi]]
        lo = hi


def words(buf: np.ndarray, offsets: np.ndarray, separators: frozenset, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the word offsets of the rows."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    if fold:
        table[65:91] = table[97:123]
    inside = table[buf]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of each byte span (spans in order, not overlapping), in bounded pieces."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        part = buf[base : ends[j - 1]]
        total = prefix(_FOLD[part] if fold else part)
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * _POW.get(len(part) + 1)[1][s]
        i = j
    return mix(out)


def prefix(part: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes' polynomial terms; total[e] - total[s] is the span's, times base**s."""
    total = np.empty(len(part) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTES[part] * _POW.get(len(part) + 1)[0][: len(part)], out=total[1:])
    return total


def prefix_items(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums over item hashes, as prefix() over bytes."""
    total = np.empty(len(hashes) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(hashes * _POW.get(len(hashes) + 1)[0][: len(hashes)], out=total[1:])
    return total


def spans_of(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [starts, ends) from prefix sums."""
    return mix((total[ends] - total[starts]) * _POW.get(len(total))[1][starts])


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k items that start at each place (n - k + 1 of them; none if fewer items)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= _C
        out += hashes[j : j + n]
    return mix(out)


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in each run of `width` values (by its upper 40 bits at least)."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = max(1, int(n).bit_length())
    low = U((1 << bits) - 1)
    packed = (values & ~low) | np.arange(n, dtype=np.uint64)
    m = -(-n // width) * width
    grid = np.full(m, ~U(0), dtype=np.uint64)
    grid[:n] = packed
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & low).astype(np.int64)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Row number of each item, from row offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def inside_rows(offsets: np.ndarray, length: int) -> np.ndarray:
    """Places at which `length` items start without crossing the end of their row."""
    n = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(n.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    return np.repeat(offsets[:-1] - (np.cumsum(n) - n), n) + np.arange(total)


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal runs, in order."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] > e[:-1]
    first = np.flatnonzero(new)
    return s[first], e[np.append(first[1:], len(s)) - 1]


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark longs."""
    return pa.array(values.view(np.int64))


def long_lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), longs(np.ascontiguousarray(values)))
