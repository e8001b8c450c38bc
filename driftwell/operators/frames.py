"""Order statistics of row frames: kernels over a block of ``segments``.

Frames of up to ``WIDE`` rows are sorted as the rows of a matrix, a few thousand at a time. Wider frames are followed by a
sorted structure in buckets: a row enters, another leaves, and the power sums of any range of ranks are added up from
whole buckets and two cut ones, in time that grows with the square root of the frame.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa

WIDE = 2048
#: Cells of a matrix of frames.
CELLS = 1 << 20
SUMS = ("S0", "S1", "S2", "S3", "S4")


class Sorted:
    """A multiset of numbers in buckets of at most ``2 * width``, with the power sums of each bucket."""

    def __init__(self, width: int) -> None:
        self.width, self.buckets, self.tops, self.sums = max(4, width), [], [], []

    def __len__(self) -> int:
        return sum(map(len, self.buckets))

    def add(self, x: float) -> None:
        if not self.buckets:
            self.buckets, self.tops, self.sums = [[x]], [x], [None]
            return
        b = min(bisect_left(self.tops, x), len(self.tops) - 1)
        bucket = self.buckets[b]
        insort(bucket, x)
        self.tops[b], self.sums[b] = bucket[-1], None
        if len(bucket) > 2 * self.width:
            half = len(bucket) // 2
            self.buckets[b : b + 1] = [bucket[:half], bucket[half:]]
            self.tops[b : b + 1] = [bucket[half - 1], bucket[-1]]
            self.sums[b : b + 1] = [None, None]

    def remove(self, x: float) -> None:
        b = bisect_left(self.tops, x)
        bucket = self.buckets[b]
        del bucket[bisect_left(bucket, x)]
        if bucket:
            self.tops[b], self.sums[b] = bucket[-1], None
        else:
            del self.buckets[b], self.tops[b], self.sums[b]

    def between(self, low: int, high: int) -> tuple[float, ...]:
        """Power sums S0 to S4 of the values of rank ``low`` up to, not including, ``high``."""
        total, at = [0.0] * 5, 0
        for b, bucket in enumerate(self.buckets):
            if at >= high:
                break
            first, last = max(0, low - at), min(len(bucket), high - at)
            if first == 0 and last == len(bucket):
                if self.sums[b] is None:
                    self.sums[b] = powers(bucket)
                part = self.sums[b]
            elif first < last:
                part = powers(bucket[first:last])
            else:
                part = (0.0,) * 5
            total = [x + y for x, y in zip(total, part, strict=True)]
            at += len(bucket)
        return tuple(total)


def powers(values: list[float]) -> tuple[float, ...]:
    x = np.array(values)
    return float(len(x)), *(float((x**p).sum()) for p in (1, 2, 3, 4))


class Block:
    """A block in order: values as doubles, which of them are there, the bounds of each row's series, and own rows."""

    def __init__(self, table: pa.Table, value: str) -> None:
        self.table = table.take(pa.array(np.argsort(table.column("pos_").to_numpy(), kind="stable")))
        column = self.table.column(value).combine_chunks()
        self.there = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
        self.v = column.to_numpy(zero_copy_only=False).astype(np.float64)
        n = len(self.v)
        first = np.flatnonzero(self.table.column("fresh_").to_numpy(zero_copy_only=False).astype(bool))
        series = np.searchsorted(first, np.arange(n), "right") - 1
        self.start, self.end = first[series] if n else first, np.append(first, n)[series + 1] if n else first
        self.own = np.flatnonzero(self.table.column("own_").to_numpy(zero_copy_only=False).astype(bool))

    def frames(self, rows: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(each row's frame [i + low, i + high) in ascending order, missing values last; how many values it has)."""
        at = rows[:, None] + np.arange(low, high)[None, :]
        inside = (at >= self.start[rows][:, None]) & (at < self.end[rows][:, None])
        at = np.clip(at, 0, len(self.v) - 1)
        inside &= self.there[at]
        return np.sort(np.where(inside, self.v[at], np.nan), axis=1), inside.sum(axis=1)

    def parts(self, *widths: int) -> list[np.ndarray]:
        return np.array_split(self.own, max(1, -(-len(self.own) * max(1, *widths) // CELLS)))

    def result(self, name: str, column: pa.Array, drop: tuple[str, ...] = ("block_", "own_", "fresh_")) -> pa.Table:
        kept = self.table.take(pa.array(self.own))
        return kept.drop_columns([c for c in kept.column_names if c in drop or c == name]).append_column(name, column)


def kept(n: np.ndarray, middle: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks [low, high) of the middle share of n values: ceil(n (1 - middle) / 2) go at each end; nothing left: an empty range."""
    off = np.ceil(n * ((1.0 - middle) / 2)).astype(np.int64)
    return off, np.maximum(off, n - off)


def middle_sums(sorted_: np.ndarray, n: np.ndarray, middle: float) -> np.ndarray:
    low, high = kept(n, middle)
    rank = np.arange(sorted_.shape[1])[None, :]
    mine = (rank >= low[:, None]) & (rank < high[:, None])
    x = np.where(mine, sorted_, 0.0)
    return np.stack([mine.sum(axis=1).astype(float), x.sum(axis=1), (x**2).sum(axis=1), (x**3).sum(axis=1), (x**4).sum(axis=1)], axis=1)


def followed_sums(block: Block, low: int, high: int, middle: float) -> np.ndarray:
    """The same for wide frames: values enter and leave one sorted structure from row to row."""
    out = np.zeros((len(block.own), 5))
    held, lo, hi, series = Sorted(int((high - low) ** 0.5)), 0, 0, -1
    for k, i in enumerate(block.own.tolist()):
        start, end = int(block.start[i]), int(block.end[i])
        first, last = min(max(i + low, start), end), max(min(i + high, end), start)
        last = max(first, last)
        if start != series or first >= hi:
            held, lo, hi, series = Sorted(int((high - low) ** 0.5)), first, first, start
        for j in range(hi, last):
            if block.there[j]:
                held.add(float(block.v[j]))
        for j in range(lo, first):
            if block.there[j]:
                held.remove(float(block.v[j]))
        lo, hi = first, max(hi, last)
        a, b = kept(np.array([len(held)]), middle)
        out[k] = held.between(int(a[0]), int(b[0]))
    return out


def structs(sums: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(sums[:, p])) for p in range(5)], names=list(SUMS))


def trimmed(value: str, low: int, high: int, middle: float, name: str, wide: int | None = None) -> Callable[[pa.Table], pa.Table]:
    """Power sums of the middle share of the frame [i + low, i + high)."""

    def run(table: pa.Table) -> pa.Table:
        block = Block(table, value)
        if high - low > (WIDE if wide is None else wide):
            sums = followed_sums(block, low, high, middle)
        else:
            parts = block.parts(high - low)
            sums = np.concatenate([middle_sums(*block.frames(rows, low, high), middle) for rows in parts])
        return block.result(name, structs(sums))

    return run


def middle_of(sorted_: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Medians of sorted rows: the mean of the middle two where their number is even; none: NaN."""
    rows, half = np.arange(len(n)), n // 2
    last = sorted_.shape[1] - 1
    high = sorted_[rows, np.minimum(half, last)]
    return np.where(n % 2 == 1, high, (sorted_[rows, np.maximum(half - 1, 0)] + high) / 2)


def shifted(value: str, width: int, middle: float, name: str) -> Callable[[pa.Table], pa.Table]:
    """struct past, future (power sums of the middles of the ``width`` rows before and from each row on) and statistic: the
    median test between both, chi-square of the counts below and above the median of both; 0 with fewer than three values."""

    def run(table: pa.Table) -> pa.Table:
        block = Block(table, value)
        found: tuple[list, list, list] = ([], [], [])
        for rows in block.parts(2 * width):
            (p, n), (q, m) = block.frames(rows, -width, 0), block.frames(rows, 0, width)
            cut = middle_of(np.sort(np.concatenate([p, q], axis=1), axis=1), n + m)[:, None]

            def term(x: np.ndarray, size: np.ndarray, cut: np.ndarray = cut) -> np.ndarray:
                below = (x < cut).sum(axis=1) + 0.5 * (x == cut).sum(axis=1)
                return 2 * (below - size / 2) ** 2 / np.maximum(size / 2, 0.5)

            found[0].append(middle_sums(p, n, middle))
            found[1].append(middle_sums(q, m, middle))
            found[2].append(np.where((n < 3) | (m < 3), 0.0, term(p, n) + term(q, m)))
        past, future, statistic = (np.concatenate(x) for x in found)
        return block.result(name, pa.StructArray.from_arrays([structs(past), structs(future), pa.array(statistic)], names=["past", "future", "statistic"]))

    return run
