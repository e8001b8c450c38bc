"""Embedding near-dedup: an exact metric range join of all vectors by cosine.

Cosine >= t is the same as Euclidean distance <= r = sqrt(2 - 2t) of the normalised vectors. Pivots (a bounded sample)
partition the vectors; a vector belongs to the cell of its nearest pivot. By the triangle inequality a vector x can only
be within r of a vector in cell p if d(x, p) <= d(x, own pivot) + 2r; among those, cells whose half-space is farther than
r from x are left out too. x is copied to such cells, and each cell compares its own vectors with themselves and with the
copies. Cells are numbered and copies go upwards only, so each pair is compared once.

Equal vectors are collapsed before. Cells over ``HOME`` vectors are cut into sub-cells, and copies over ``GUESTS`` are dealt
to several tasks, so no task holds more than a bounded number of rows. No pair is written: a cell returns counts
and, for components, one edge per linked vector.

Edge cases: vectors that are null, zero or hold null or non-finite components link with nothing, nor do rows with a null id
(component null, kept); each length of vectors has cells of its own; repeated rows are links of each other; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels, vectors
from .common import Stash, ship
from .graph import components

#: Vectors for each pivot, most pivots, vectors of a sub-cell, copies in a task.
CELL, PIVOTS, HOME, GUESTS = 2048, 4096, 4096, 8192
#: Rounding of distances: copies are made a little beyond r, and products near the threshold are computed anew.
SLACK = 1e-9


class Cells:
    def __init__(self, pivots: np.ndarray, threshold: float) -> None:
        self.pivots = pivots / vectors.norms(pivots)[:, None]
        self.r = np.sqrt(2 - 2 * threshold) + SLACK
        self.between = np.sqrt(np.maximum(0, 2 - 2 * self.pivots @ self.pivots.T))
        self.blocks = np.ones(len(pivots), np.int64)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(own cell, may have partners in cell p) of each row."""
        x = x / vectors.norms(x)[:, None]
        s = x @ self.pivots.T
        d = np.sqrt(np.maximum(0, 2 - 2 * s))
        own = s.argmax(axis=1)
        rows = np.arange(len(x))
        near = d <= d[rows, own][:, None] + 2 * self.r
        near &= s[rows, own][:, None] - s <= self.r * self.between[own] + SLACK
        return own, near

    def block(self, ids: np.ndarray, own: np.ndarray) -> np.ndarray:
        return (kernels.mix(ids.astype(np.uint64)) % self.blocks[own].astype(np.uint64)).astype(np.int64)

    def copies(self, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """(own sub-cell of each row; rows and sub-cells of the copies): sub-cells are numbered cell by cell."""
        first = np.append(0, self.blocks.cumsum())
        own, near = self.place(x)
        home = first[own] + self.block(ids, own)
        cell = np.repeat(np.arange(len(self.blocks)), self.blocks)
        wide = near[:, cell] & (np.arange(first[-1])[None] > home[:, None])
        row, sub = np.nonzero(wide)
        return home, row, sub


def count_cells(cells, copies: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(cells.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, ids = vectors.matrix(batch.column("vec")), batch.column("id").to_numpy()
            for i in range(0, len(x), 1024):
                out = own.copies(ids[i : i + 1024], x[i : i + 1024])[2] if copies else own.place(x[i : i + 1024])[0]
                cell, n = np.unique(out, return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cell.astype(np.int64)), "n": pa.array(n.astype(np.int64))})

    return run


def deal(cells, tasks):
    """Rows for the cells: (sub-cell, task, id, n, vec, home)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(cells.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                x, ids = vectors.matrix(part.column("vec")), part.column("id").to_numpy()
                home, row, sub = held.copies(ids, x)
                many = tasks.value[home]
                own = np.repeat(np.arange(len(ids)), many)
                at = np.append(own, row)
                task = np.append(np.arange(len(own)) - np.repeat(many.cumsum() - many, many), (kernels.mix(ids[row].astype(np.uint64) + np.uint64(1)) % tasks.value[sub].astype(np.uint64)).astype(np.int64))
                take = pa.array(at)
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(np.append(home[own], sub)), "task": pa.array(task), "id": part.column("id").take(take),
                    "n": part.column("n").take(take), "vec": part.column("vec").take(take), "home": pa.array(np.arange(len(at)) < len(own)),
                })

    return run


def compare(threshold: float):
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["home", "id"], ascending=[False, True], kind="stable")
        x = np.stack(frame["vec"].to_numpy()).astype(np.float64)
        ids, n, h = frame["id"].to_numpy(), frame["n"].to_numpy(), int(frame["home"].sum())
        size = vectors.norms(x)
        unit = x / size[:, None]
        links = np.zeros(len(x), np.int64)
        us, vs = [], []
        for i in range(0 if key[1] == 0 else h, len(x), 512):
            s = unit[i : i + 512] @ unit[:h].T
            hit = s >= threshold
            u, v = np.nonzero(np.abs(s - threshold) < SLACK)
            hit[u, v] = (x[u + i] * x[v]).sum(axis=1) / (size[u + i] * size[v]) >= threshold
            rows = np.arange(i, min(i + 512, len(x)))
            inside = rows < h
            hit[np.flatnonzero(inside), rows[inside]] = False
            links[rows] += hit @ n[:h]
            # A copy's links count for the cell's own vectors too; those of two own vectors are met from both sides.
            links[:h] += n[rows[~inside]] @ hit[~inside]
            u, v = np.nonzero(hit)
            us.append(u + i)
            vs.append(v)
        u, v = np.concatenate(us) if us else np.zeros(0, int), np.concatenate(vs) if vs else np.zeros(0, int)
        label = np.arange(len(x))
        while True:
            before = label.copy()
            np.minimum.at(label, u, label[v])
            np.minimum.at(label, v, label[u])
            label = label[label]
            if (label == before).all():
                break
        some = np.flatnonzero(links > 0)
        return pd.DataFrame({"a": ids[some], "b": ids[label[some]], "links": links[some]})

    return run


def links_in(distinct: DataFrame, total: int, threshold: float) -> DataFrame:
    """a, b, links from the cells, for vectors of one length."""
    spark = distinct.sparkSession
    many = int(np.clip(-(-total // CELL), 1, PIVOTS))
    pivots = distinct.orderBy(F.xxhash64("id"), "id").limit(many).select("vec").toArrow()
    own = Cells(vectors.matrix(pivots.column("vec")) if total else np.ones((1, 1)), threshold)

    def counted(copies: bool, size: int) -> np.ndarray:
        """Numbers of cells or sub-cells: at most PIVOTS + total / HOME rows."""
        out = np.zeros(size, np.int64)
        held = spark.sparkContext.broadcast(cloudpickle.dumps(own))  # by value: executors need not have this package
        for r in distinct.mapInArrow(count_cells(held, copies), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            out[r["cell"]] = r["n"]
        return out

    own.blocks = np.maximum(1, -(-counted(False, many) // HOME))
    guests = counted(True, int(own.blocks.sum()))
    cells, tasks = spark.sparkContext.broadcast(cloudpickle.dumps(own)), spark.sparkContext.broadcast(np.maximum(1, -(-guests // GUESTS)))
    kind = dict(distinct.dtypes)["vec"]
    dealt = distinct.select("id", "n", "vec").mapInArrow(deal(cells, tasks), f"cell long, task long, id long, n long, vec {kind}, home boolean")
    return dealt.groupBy("cell", "task").applyInPandas(compare(threshold), "a long, b long, links long")


def near_duplicates(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, n_links, component_id, kept: vectors link when their cosine is at least ``threshold``."""
    for m in (kernels, vectors, sys.modules[__name__]):
        ship(m)
    spark = df.sparkSession
    stash = Stash(spark, "vector_dedup")
    print_ = lambda *c: F.when(F.col("vec").isNotNull(), F.xxhash64(*c))
    rows = vectors.flagged(df, key, vector, stash).withColumn("h1", print_("vec")).withColumn("h2", print_(F.reverse("vec"), F.lit(1)))
    distinct = stash.keep(rows.filter("vec is not null").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("vec").alias("vec")), "distinct")
    found = reduce(DataFrame.unionByName, [links_in(part, total, threshold) for part, total in vectors.spaces(distinct)])
    found = stash.keep(found, "links")
    linked = found.groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b"), stash)
    classes = (
        distinct.select("h1", "h2", "id", "n").join(linked, F.col("id") == F.col("a"), "left").join(joined, F.col("id") == F.col("node"), "left")
        .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    joined = rows.select("id", "h1", "h2").join(classes, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))
