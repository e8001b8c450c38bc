"""Vectorised text kernels over Arrow string columns (numpy only)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a kernel works on at once; a longer text is a piece of its own.
CHUNK = 1 << 21
#: Odd constants of the splitmix64 finaliser and of the polynomial over a word's bytes.
MIX1, MIX2, BASE = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * MIX1
    h = h ^ (h >> np.uint64(27))
    h = h * MIX2
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: np.uint64 = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; nulls are empty texts."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        j = min(j, n)
        yield i, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text plus the total, start byte of each word)."""
    if lower:
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    n = len(raw)
    ink = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    first[at] = ink[at]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds, starts
    lengths = np.diff(np.append(starts, n))
    local = np.arange(starts[0], n) - np.repeat(starts, lengths)
    value = np.where(ink[starts[0] :], raw[starts[0] :].astype(np.uint64) + np.uint64(1), np.uint64(0))
    hashes = np.add.reduceat(value * powers(int(lengths.max()))[local], starts - starts[0])
    return mix(hashes), bounds, starts


def shingles(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its word shingles); fewer words make one shingle, no words none."""
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    for row, raw, offsets in chunks(column):
        hashes, bounds, _ = words(raw, offsets)
        m = len(hashes) - size + 1
        rolled = np.zeros(max(m, 0), np.uint64)
        for k in range(size if m > 0 else 0):
            rolled += hashes[k : k + m] * factors[k]
        rolled = mix(rolled)
        for i in range(len(offsets) - 1):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= size:
                yield row + i, np.unique(rolled[a : b - size + 1])
            elif b > a:
                short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield row + i, mix(np.array([short], np.uint64))
            else:
                yield row + i, np.zeros(0, np.uint64)
