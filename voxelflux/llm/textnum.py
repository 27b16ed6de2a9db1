"""Numpy views of Arrow text columns: bytes, word bounds and word hashes without a Python loop over rows.

The Arrow functions of this subpackage work on slices of a few MB, so a task's memory does not follow
the size of its partition; one text that is longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64

#: The ASCII white space of the word pattern [^\x20\x09-\x0D]+
SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i below n; kept and doubled when a longer text comes."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        for name, base in (("up", BASE), ("down", inverse)):
            out = np.empty(size, U64)
            out[0] = 1
            filled, step = 1, base
            while filled < size:
                out[filled : 2 * filled] = out[:filled] * U64(step)
                step = step * step % (1 << 64)
                filled *= 2
            _powers[name] = out
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the public splitmix64 finalizer)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def slices(table: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch that hold about limit bytes of text each, one row at least."""
    arr = table.column(column)
    if len(arr) == 0:
        return
    _, offsets = raw(arr)
    row = 0
    while row < len(arr):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield table.slice(row, end - row)
        row = end


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the n + 1 offsets of its rows into them; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_string(arr.type) or pa.types.is_binary(arr.type):
        width = np.int32
    elif pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        width = np.int64
    else:
        return raw(arr.cast(pa.large_string()))
    if arr.null_count:
        arr = arr.fill_null("" if "string" in str(arr.type) else b"")
    _, places, data = arr.buffers()
    if places is None or len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(places, width, len(arr) + 1, arr.offset * np.dtype(width).itemsize).astype(np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8, last - first, first) if data is not None and last > first else np.zeros(0, np.uint8)
    return data, offsets - first


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross rows: their starts, ends and rows."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    first = first[:n]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(offsets, starts, side="right") - 1


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says."""
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - upto + sizes, sizes)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words [^\\x20\\x09-\\x0D]+ of every row."""
    return runs(~IS_SPACE[data], offsets)


class Hasher:
    """Hashes of any substrings of one buffer (bytes or code points) from one prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(U64)
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + length)


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words and their rows; a row with fewer words gives its whole sequence once."""
    n = len(hashes)
    counts = np.bincount(rows, minlength=n_rows)
    out, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    if n >= k:
        whole = rows[: n - k + 1] == rows[k - 1 :]
        h = np.zeros(n - k + 1, U64)
        for j in range(k):
            h = mix(h + hashes[j : n - k + 1 + j] + U64(j + 1))
        out, owner = h[whole], rows[: n - k + 1][whole]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        first = np.searchsorted(rows, few)
        h = np.zeros(len(few), U64)
        for j in range(k - 1):
            there = counts[few] > j
            h[there] = mix(h[there] + hashes[first[there] + j] + U64(j + 1))
        out = np.concatenate([out, mix(h + counts[few].astype(U64) * U64(BASE))])
        owner = np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def distinct(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes without repeats inside a row, sorted by row and hash, and the n_rows + 1 offsets of the rows."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[keep], r[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n_rows))]).astype(np.int64)


def binary(parts: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose row i is the bytes of parts[offsets[i]:offsets[i + 1]]."""
    width = parts.dtype.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(parts))]
    )
