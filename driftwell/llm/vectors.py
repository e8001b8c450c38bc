"""What the vector operators share: which vectors take part, and arrays from Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flagged(df: DataFrame, key: str, vector: str, stash) -> DataFrame:
    """(id, vec) of all rows; vec is null where it is null, zero, holds a null or non-finite component, or has no id."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col(key).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    return stash.keep(df.select(F.col(key).cast("long").alias("id"), F.when(good, F.col(vector)).alias("vec")), "flagged")


def usable(df: DataFrame, key: str, vector: str, stash) -> DataFrame:
    return flagged(df, key, vector, stash).filter("vec is not null")


def spaces(rows: DataFrame) -> list[tuple[DataFrame, int]]:
    """(vectors, their number) of each length: vectors of different lengths have no cosine. No vectors: one empty space."""
    counted = sorted((r["dim"], r["count"]) for r in rows.groupBy(F.size("vec").alias("dim")).count().collect())
    if len(counted) < 2:
        return [(rows, sum(n for _, n in counted))]
    return [(rows.filter(F.size("vec") == dim), n) for dim, n in counted]


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))
