"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits at the median of a random projection, on ``DEPTH`` levels (fewer only where leaves would hold less than
``LEAF``); medians come from a sample of at most ``SAMPLE`` vectors, and every vector is put into a leaf of each tree. Trees
do not deepen with the table, so a query opens about as many leaves whatever the table's size. A query searches all trees through one priority queue of
margins: the branch nearest to any split is opened next, until the leaves hold ``SHARE`` of the vectors, trees counted
separately. The leaves' vectors are ranked exactly and the best of all leaves are merged.

Leaves are cut into parts of at most about ``PART`` vectors (equal vectors share a leaf, however many they are), and a
query goes to each part.

Edge cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a null id;
each length of vectors has a forest of its own; repeated rows are separate candidates, but a row with the query's id is never a candidate; with fewer than
k candidates all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernels, vectors
from .common import Stash, ship

SAMPLE, TREES, LEAF, DEPTH = 1 << 16, 16, 8, 6
#: Vectors in the opened leaves, over all trees, as a share of all vectors; recall in the README was measured with it.
SHARE = 1.2
PART = 4096
#: Differences of a fast product that a slow, reproducible one then decides.
SLACK = 1e-9


class Forest:
    def __init__(self, x: np.ndarray, total: int, seed: int = 17) -> None:
        rng = np.random.default_rng(seed)
        self.depth = int(np.clip(np.round(np.log2(max(total, 1) / LEAF)), 0, DEPTH))
        inner = 2**self.depth - 1
        x = x / vectors.norms(x)[:, None]
        self.planes = rng.standard_normal((TREES, inner, x.shape[1]))
        self.cuts = np.zeros((TREES, inner))
        for t in range(TREES):
            node = np.zeros(len(x), int)
            for level in range(self.depth):
                first = 2**level - 1
                p = np.einsum("ij,ij->i", x, self.planes[t, node])
                order = np.lexsort([p, node])
                bounds = np.searchsorted(node[order], np.arange(first, first + 2**level + 1))
                for k in range(2**level):
                    if bounds[k + 1] > bounds[k]:
                        self.cuts[t, first + k] = p[order[(bounds[k] + bounds[k + 1]) // 2]]
                node = 2 * node + 1 + (p > self.cuts[t, node])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(tree, row) → leaf."""
        x = x / vectors.norms(x)[:, None]
        out = np.zeros((TREES, len(x)), np.int64)
        for t in range(TREES):
            node = out[t]
            for _ in range(self.depth):
                node = 2 * node + 1 + (np.einsum("ij,ij->i", x, self.planes[t, node]) > self.cuts[t, node])
            out[t] = node - (2**self.depth - 1)
        return out

    def search(self, x: np.ndarray, sizes: np.ndarray, budget: float) -> list[list[tuple[int, int]]]:
        """For each row the leaves (tree, leaf) to open; sizes: (tree, leaf) → vectors."""
        x = x / vectors.norms(x)[:, None]
        sides = np.stack([x @ p.T - c for p, c in zip(self.planes, self.cuts, strict=True)], axis=1) if self.depth else np.zeros((len(x), TREES, 0))
        inner, out = 2**self.depth - 1, []
        for row in sides:
            side = row.tolist()
            heap, held, found = [(-np.inf, t, 0) for t in range(TREES)], 0, []
            while heap and held < budget:
                margin, t, node = heapq.heappop(heap)
                while node < inner:
                    s = side[t][node]
                    heapq.heappush(heap, (max(margin, abs(s)), t, 2 * node + 1 + (s <= 0)))
                    node = 2 * node + 1 + (s > 0)
                if n := int(sizes[t, node - inner]):
                    found.append((t, node - inner))
                    held += n
            out.append(found)
        return out


def put(forest, parts):
    """Every vector into a part of a leaf of each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(forest.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            leaf = own.leaves(vectors.matrix(batch.column("vec")))
            for t in range(TREES):
                if parts is None:
                    yield pa.RecordBatch.from_pydict({"leaf": pa.array((t << 32) + leaf[t])})
                    continue
                many = parts.value[t, leaf[t]]
                part = (kernels.mix(ids.astype(np.uint64)) % many.astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"leaf": pa.array((t << 32) + leaf[t]), "part": pa.array(part), "id": batch.column("id"), "h": batch.column("h"), "n": batch.column("n"), "vec": batch.column("vec"), "query": pa.array(np.zeros(len(ids), bool))})

    return run


def ask(forest, parts, sizes, budget: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(forest.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = own.search(vectors.matrix(batch.column("vec")), sizes.value, budget)
            rows = [(i, (t << 32) + leaf, p) for i, ls in enumerate(found) for t, leaf in ls for p in range(int(parts.value[t, leaf]))]
            for k in range(0, len(rows), 1 << 14):
                at, leaf, part = zip(*rows[k : k + (1 << 14)], strict=True)
                at = pa.array(at)
                yield pa.RecordBatch.from_pydict({"leaf": pa.array(leaf), "part": pa.array(part), "id": batch.column("id").take(at), "h": batch.column("h").take(at), "n": batch.column("n").take(at), "vec": batch.column("vec").take(at), "query": pa.array(np.ones(len(at), bool))})

    return run


def rank(k: int):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        q, c = frame[frame["query"]], frame[~frame["query"]]
        out: list[tuple] = []
        if len(q) and len(c):
            x, ids, h, n = np.stack(c["vec"].to_numpy()).astype(np.float64), c["id"].to_numpy(), c["h"].to_numpy(), c["n"].to_numpy()
            size = vectors.norms(x)
            own = np.stack(q["vec"].to_numpy()).astype(np.float64)
            for i in range(0, len(q), 256):
                fast = own[i : i + 256] @ x.T / size
                for j, qid in enumerate(q["id"].to_numpy()[i : i + 256]):
                    v = own[i + j]
                    s = np.where(ids == qid, -np.inf, fast[j])
                    low = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                    near = np.flatnonzero((s >= low - SLACK * np.sqrt(v @ v)) & (ids != qid))
                    exact = (x[near] * v).sum(axis=1) / (size[near] * vectors.norms(v[None])[0])
                    best = np.lexsort([ids[near], -exact])[:k]
                    out += [(qid, ids[near][b], h[near][b], exact[b], n[near][b]) for b in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "h", "score", "n"]).astype({"query_id": "int64", "vec_id": "int64", "h": "int64", "score": "float64", "n": "int64"})

    return run


def found_in(good: DataFrame, total: int, queries: Column, k: int, key: str, share: float) -> DataFrame:
    """query_id, vec_id, h (the vector's hash), score from the leaves, for vectors of one length."""
    spark = good.sparkSession
    sample = good.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").toArrow()
    own = Forest(vectors.matrix(sample.column("vec")) if total else np.ones((1, 1)), total)
    forest = spark.sparkContext.broadcast(cloudpickle.dumps(own))  # by value: executors need not have this package
    counted = good.mapInArrow(put(forest, None), "leaf long").groupBy("leaf").count().collect()  # TREES * 2**DEPTH rows at most
    sizes = np.zeros((TREES, 2**own.depth), np.int64)
    for r in counted:
        sizes[r["leaf"] >> 32, r["leaf"] & 0xFFFFFFFF] = r["count"]
    held, parts = spark.sparkContext.broadcast(sizes), spark.sparkContext.broadcast(np.maximum(1, -(-sizes // PART)))
    kind = dict(good.dtypes)["vec"]
    schema = f"leaf long, part long, id long, h long, n long, vec {kind}, query boolean"
    asked = good.withColumnRenamed("id", key).filter(queries).withColumnRenamed(key, "id").mapInArrow(ask(forest, parts, held, share * total), schema)
    both = good.mapInArrow(put(forest, parts), schema).unionByName(asked)
    return both.groupBy("leaf", "part").applyInPandas(rank(k), "query_id long, vec_id long, h long, score double, n long")


def nearest(df: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows that satisfy ``queries``, the k nearest other rows found, by cosine."""
    for m in (kernels, vectors, sys.modules[__name__]):
        ship(m)
    stash = Stash(df.sparkSession, "nearest")
    # Rows equal in id and vector go as one with their number.
    rows = vectors.usable(df, key, vector, stash).groupBy("id", F.xxhash64("vec").alias("h")).agg(F.first("vec").alias("vec"), F.count("*").alias("n"))
    good = stash.keep(rows.select("id", "h", "n", "vec"), "distinct")
    found = reduce(DataFrame.unionByName, [found_in(rows, total, queries, k, key, share) for rows, total in vectors.spaces(good)])
    # A candidate comes from several trees, with its hash, as an id may have several vectors; one that stands for n rows takes n ranks.
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least("n", F.lit(k).cast("long"))))
    return found.distinct().withColumn("copy", each).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
