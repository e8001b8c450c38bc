"""The nearest of a few integer vectors: float32 products first, int64 wherever their rounding could matter.

Components are integers floor(scale * x), limited to +-floor(sqrt(2^61 / length) / 2), so that a squared distance of whole
vectors fits 64 bits and is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Unit roundoff of float32, components in one float32 product, rows screened at once.
UNIT, BLOCK, ROWS = 2.0**-24, 4096, 4096


def limit(length: int) -> int:
    return math.floor(math.sqrt(2.0**61 / max(1, length)) / 2)


def lists(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their components as a matrix) of the lists in a batch that are not null; null components become NaN."""
    sizes = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes >= 0]):
        at = np.flatnonzero(sizes == size)
        for i in range(0, len(at), ROWS):
            some = at[i : i + ROWS]
            yield int(size), some, column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(len(some), int(size))


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for size, at, x in lists(column):
        yield size, at, x.astype(np.int64)


def cut(scale: int, length: int | None = None) -> Callable:
    """From (..., vec) the rows whose vectors are whole, and of the wanted length, with ``ints`` in place of ``vec``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [n for n in batch.schema.names if n != "vec"]
            for size, at, raw in lists(batch.column("vec")):
                x = raw.astype(np.float64)
                whole = np.isfinite(x).all(axis=1)
                if length not in (None, size) or not whole.any():
                    continue
                with np.errstate(over="ignore"):  # a product beyond the doubles is infinite and meets the limit
                    ints = np.clip(np.floor(x[whole] * float(scale)), -limit(size), limit(size)).astype(np.int32)
                ends = pa.array(np.arange(len(ints) + 1, dtype=np.int32) * size)
                kept = [batch.column(n).take(pa.array(at[whole])) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(ends, pa.array(ints.ravel()))], names=[*names, "ints"])

    return run


def kept(df: DataFrame, vector: str, scale: int, length: int | None = None, **others: str) -> DataFrame:
    """The columns named in ``others`` and ``ints``, floor(scale * x) of each component, of all whole vectors."""
    kind = dict(df.dtypes)[vector]
    vec = F.col(vector) if kind in ("array<float>", "array<double>") else F.col(vector).cast("array<double>")
    rows = df.select(*[F.col(c).alias(n) for n, c in others.items()], vec.alias("vec"))
    return rows.mapInArrow(cut(scale, length), ", ".join([f"{n} {t}" for n, t in rows.dtypes if n != "vec"] + ["ints array<int>"]))


def bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) between which |c|^2 - 2 x.c lies for each pair of rows.

    A float32 product of b components differs from the exact one by (b + 3) * UNIT * |x| * |c| at most: b roundings of the
    sum, in any order, and one of each factor. Longer vectors are cut into blocks whose products are summed in double
    precision; the second term covers what that and the norms round.
    """
    d = x.shape[1]
    xd, cd = x.astype(np.float64), c.astype(np.float64)
    size = np.sqrt((xd * xd).sum(axis=1))[:, None] * np.sqrt((cd * cd).sum(axis=1))[None, :]
    own = (cd * cd).sum(axis=1)[None, :]
    dot = np.zeros((len(x), len(c)))
    for at in range(0, d, BLOCK):
        dot += xd[:, at : at + BLOCK].astype(np.float32) @ cd[:, at : at + BLOCK].astype(np.float32).T
    slack = 2.02 * (min(d, BLOCK) + 4) * UNIT * size + (d + 8) * 2.0**-51 * (own + 2.02 * size)
    score = own - 2 * dot
    return score - slack, score + slack


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``c``, squared distance) of each row of ``x``; ties go to the first row of ``c``."""
    place, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    step = max(1, ROWS * 64 // max(1, x.shape[1]))
    for i in range(0, len(x), step):
        some = x[i : i + step]
        low, high = bounds(some, c)
        rows, cols = np.nonzero(low <= high.min(axis=1)[:, None])
        gap = some[rows] - c[cols]
        exact = np.einsum("ij,ij->i", gap, gap)
        best = np.minimum.reduceat(exact, np.searchsorted(rows, np.arange(len(some))))
        hit = np.flatnonzero(exact == best[rows])
        _, first = np.unique(rows[hit], return_index=True)
        place[i : i + step], distance[i : i + step] = cols[hit[first]], best
    return place, distance


def summed(x: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of ``x`` by place; exact in double precision, as ``ROWS`` limited integers stay below 2^53."""
    return ((place[None, :] == np.arange(k)[:, None]).astype(np.float64) @ x.astype(np.float64)).astype(np.int64)
