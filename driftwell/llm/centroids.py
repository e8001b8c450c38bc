"""Centroid clustering over integer components: the same clusters on every machine and under every split of the rows.

Components become floor(scale * x). Centroids start as the vectors with the smallest hashes of their ids; each round
assigns every vector to its nearest centroid (float32 screening, int64 where intervals overlap, ties to the smaller
number: ``screening``), then every centroid with vectors becomes the floored mean of them.

Every round reads all vectors once: tasks add up their vectors by cluster, Spark adds up the tasks, and the driver holds
nothing but the centroids.

Edge cases: vectors that are null, hold null or non-finite components or have another length than ``length`` are left out;
null ids come last in the order of hashes, equal ids are ordered by their vectors and repeated rows are separate vectors;
with fewer vectors than centroids there are fewer centroids; components beyond the limit of ``screening`` count as that
limit; an inertia that no long holds is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import screening
from .common import Stash, ship

LONG = 2**63 - 1


def totals(centers: np.ndarray) -> Callable:
    """From (ints): how many vectors each centroid got in this task, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centers), np.int64), np.zeros(centers.shape, np.int64)
        for batch in batches:
            for _, _, x in screening.by_length(batch.column("ints")):
                place, _ = screening.nearest(x, centers)
                n += np.bincount(place, minlength=len(centers))
                sums += screening.summed(x, place, len(centers))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used.astype(np.int32)), "n": pa.array(n[used]), "sums": pa.array([sums[c].tolist() for c in used], pa.list_(pa.int64()))})

    return run


def placed(centers: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, at, x in screening.by_length(batch.column("ints")):
                place, distance = screening.nearest(x, centers)
                yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(pa.array(at)), "cluster": pa.array(place.astype(np.int32)), "distance": pa.array(distance)})

    return run


def moved(kept: DataFrame, centers: np.ndarray) -> np.ndarray:
    found = kept.select("ints").mapInArrow(totals(centers), "cluster int, n long, sums array<long>")
    sums = found.select("cluster", "n", F.posexplode("sums").alias("pos", "x")).groupBy("cluster", "pos")
    out = centers.copy()
    for r in sums.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect():  # centroids x length rows at most
        out[r["cluster"], r["pos"]] = int(r["x"]) // r["n"]
    return out


def starts(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "ints").limit(k).select("ints").collect()
    return np.array([r["ints"] for r in first], np.int64)


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, length: int = 64, scale: int = 64, seed: int = 1, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector of that length."""
    for m in (screening, sys.modules[__name__]):
        ship(m)
    spark = df.sparkSession
    stash = Stash(spark, "centroids")
    kept = stash.keep(screening.kept(df, vector, scale, length, id=key), "kept")
    centers = starts(kept, k, seed)
    if not len(centers):
        return kept.selectExpr(f"id AS `{key}`", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(rounds):
        centers = moved(kept, centers)
    done = stash.keep(kept.mapInArrow(placed(centers), f"id {dict(kept.dtypes)['id']}, cluster int, distance long"), "placed")
    held = dict(done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # one row a centroid
    sums = [int(held.get(c, 0)) for c in range(len(centers))]

    def long(x: int) -> Column:
        return F.lit(x if x <= LONG else None).cast("long")

    prints = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centers.tolist()]
    return done.select(
        F.col("id").alias(key), "cluster", "distance", F.get(F.array(*map(long, sums)), F.col("cluster")).alias("cluster_inertia"), long(sum(sums)).alias("inertia"),
        F.get(F.array(*prints), F.col("cluster")).alias("centroid_sha256"),
    )
