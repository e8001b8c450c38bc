"""Best-fit packing of tokenised documents into sequences under three capacities.

Bins have capacities for tokens, documents and attention cost (the sum of squared lengths). Pieces go in by decreasing
length; among the bins that can take a piece under every capacity, the one whose residual vector has the smallest
weighted norm afterwards is chosen ("best fit"); a bin is opened only where none can.

Pieces of one length are alike, so the plan is made from the counts of lengths (at most ``tokens`` numbers, whatever the
input's size): bins with equal fill are handled as ranges of sequence ids. The plan says, for a range of ranks among the
pieces of one length, which sequences and offset they get. Ranks are counted in hash classes of each length, so that a
length that a third of all pieces share is spread over many tasks.

Edge cases: a null text is empty and becomes one piece holding only the end id; a null id is an ordinary value; repeated
rows are separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import kernels, tokens
from .common import Stash, ship

TOKENS, END = 1024, 2
#: Weights of the residual tokens, documents and attention cost in the norm.
WEIGHTS = (1.0, 1.0, 1.0)
SALTS = 64

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("salt", pa.int32())])


def cut_pieces(definition, most: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, rows = batch.column("doc_id").to_pylist(), []
            for row, ids in tokens.encode_column(batch.column("text"), definition.value):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                first = (len(ids) - 1) % most + 1
                at = 0
                for k, stop in enumerate(range(first, len(ids) + 1, most)):
                    crc = zlib.crc32(ids[at:stop].tobytes())
                    rows.append((doc[row], k, at, stop - at, crc, (crc ^ zlib.crc32(b"%d %d" % (doc[row] or 0, k))) % SALTS))
                    at = stop
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), PIECE, strict=True)], schema=PIECE)

    return run


def plan(counts: dict[int, int], most: int, documents: int, cost: int, weights: tuple = WEIGHTS) -> list[tuple]:
    """Rows (length, first rank, ranks, first sequence, offset): piece of rank first + i goes to sequence + i at offset."""
    # Bins of equal fill (tokens, documents, cost): lists of ranges of sequence ids.
    bins: dict[tuple, list[list[int]]] = {}
    rows, opened = [], 0
    caps = np.array([most, documents, cost], float)

    def fits(fill: tuple, length: int) -> int:
        """How many pieces of this length go in."""
        return min((most - fill[0]) // length, documents - fill[1], (cost - fill[2]) // (length * length))

    def place(fill: tuple, seq: int, k: int, length: int, each: int, rank: int) -> None:
        for j in range(each):
            rows.append((length, rank + j * k, k, seq, fill[0] + j * length))
        after = (fill[0] + each * length, fill[1] + each, fill[2] + each * length * length)
        if after[0] < most:
            bins.setdefault(after, []).append([seq, k])

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        usable = [f for f in bins if fits(f, length) > 0]
        if usable:
            after = caps - (np.array(usable, float) + np.array([length, 1, length * length]))
            norm = ((after / caps) ** 2 * np.array(weights)).sum(axis=1)
            usable = [usable[i] for i in np.argsort(norm, kind="stable")]
        for fill in usable:
            if not left:
                break
            each, ranges = fits(fill, length), bins.pop(fill)
            while ranges and left:
                seq, k = ranges.pop()
                take = min(k, left // each)
                if take:
                    place(fill, seq, take, length, each, rank)
                    rank, left = rank + take * each, left - take * each
                if take < k and left and left < each:
                    place(fill, seq + take, 1, length, left, rank)
                    rank, left, take = rank + left, 0, take + 1
                if take < k:
                    ranges.append([seq + take, k - take])
            if ranges:
                bins.setdefault(fill, []).extend(ranges)
        if left:
            each = fits((0, 0, 0), length)
            if each < 1:
                raise ValueError(f"a piece of {length} exceeds a capacity")
            for n, k in ((each, left // each), (left % each, 1)):
                if n and k:
                    place((0, 0, 0), opened, k, length, n, rank)
                    opened, rank = opened + k, rank + n * k
    return rows


def assign(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, seq, offset = table.value
        for batch in batches:
            mine = (batch.column("length").to_numpy() << 44) + batch.column("rank").to_numpy()
            at = np.searchsorted(key, mine, "right") - 1
            out = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "crc")}
            out["sequence_id"] = pa.array(seq[at] + (mine & ((1 << 44) - 1)) - first[at])
            out["offset"] = pa.array(offset[at])
            yield pa.RecordBatch.from_pydict(out)

    return run


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", most: int = TOKENS, documents: int = TOKENS, cost: int = TOKENS * TOKENS, end: int = END) -> DataFrame:
    """key, piece, start, length, ids_crc32, sequence_id, offset. ``tokenizer``: path of a byte-level BPE definition."""
    for m in (kernels, tokens, sys.modules[__name__]):
        ship(m)
    spark = docs.sparkSession
    stash = Stash(spark, "packing")
    definition = spark.sparkContext.broadcast(Path(tokenizer).read_text())
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = stash.keep(source.mapInArrow(cut_pieces(definition, most, end), "doc_id long, piece int, start long, length long, crc long, salt int"), "pieces")
    # At most ``most`` * SALTS numbers come to the driver.
    counted = sorted((r["length"], r["salt"], r["count"]) for r in pieces.groupBy("length", "salt").count().collect())
    totals: dict[int, int] = {}
    bases = []
    for length, salt, n in counted:
        bases.append((length, salt, totals.get(length, 0)))
        totals[length] = totals.get(length, 0) + n
    rows = sorted(plan(totals, most, documents, cost))
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    table = spark.sparkContext.broadcast(((columns[0] << 44) + columns[1], columns[1], columns[3], columns[4]))
    base = F.broadcast(spark.createDataFrame(bases, "length long, salt int, base long"))
    rank = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "crc"))
    ranked = pieces.join(base, ["length", "salt"]).withColumn("rank", F.col("base") + rank - 1).drop("base", "salt")
    done = ranked.mapInArrow(assign(table), "doc_id long, piece int, start long, length long, crc long, sequence_id long, offset long")
    return done.withColumnRenamed("crc", "ids_crc32").withColumnRenamed("doc_id", key)
