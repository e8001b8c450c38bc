"""Vector code compression: product codes over integer components, exact whatever the machine's floating point does.

Each component becomes floor(scale * x); a vector is cut into equal consecutive parts, and each part is replaced by the
number of its nearest codebook entry. Entries start as the parts of the vectors with the smallest ids and become the
floored means of their parts in each round. The assignment screens with float32 products and decides in int64
(``screening``), ties to the smaller number.

Every round reads all vectors once: tasks add up their parts, Spark adds up the tasks, and the driver holds nothing but
codebooks (entries x length numbers for each length of vector).

Edge cases: vectors that are null or hold null or non-finite components are left out; vectors of each length have
codebooks of their own; a length that is no multiple of the parts is filled up with zeros; vectors without components
have distance 0; null ids come last in the order of ids and repeated ids are ordered by their vectors; with fewer vectors
than entries there are fewer entries; components beyond the limit of ``screening`` count as that limit; a sum of errors
that no long holds is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import screening
from .common import Stash, ship

#: length of vector -> entries x filled-up length
Books = dict[int, np.ndarray]


def width(length: int, parts: int) -> int:
    return -(-length // parts)


def filled(x: np.ndarray, parts: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, parts * width(x.shape[1], parts) - x.shape[1])))


def _coded(x: np.ndarray, book: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its components, entries, squared distances)"""
    w = x.shape[1] // parts
    for part in range(parts):
        mine = x[:, part * w : part * w + w]
        yield part, mine, *screening.nearest(mine, book[:, part * w : part * w + w])


def totals(books: Books, parts: int) -> Callable:
    """From (ints): how many parts each entry got in this task, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for length, _, x in screening.by_length(batch.column("ints")):
                book = books[length]
                for part, mine, entry, _ in _coded(filled(x, parts), book, parts):
                    n, sums = held.setdefault((length, part), (np.zeros(len(book), np.int64), np.zeros((len(book), mine.shape[1]), np.int64)))
                    n += np.bincount(entry, minlength=len(book))
                    sums += screening.summed(mine, entry, len(book))
        out = [(length, part, e, int(n[e]), sums[e].tolist()) for (length, part), (n, sums) in held.items() for e in np.flatnonzero(n).tolist()]
        if out:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("length", "part", "entry", "n", "sums"), r, strict=True)) for r in out],
                pa.schema([("length", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]),
            )

    return run


def moved(kept: DataFrame, books: Books, parts: int) -> Books:
    """One round: each entry becomes the floored mean of its parts; unused entries stay."""
    found = kept.select("ints").mapInArrow(totals(books, parts), "length int, part int, entry int, n long, sums array<long>")
    sums = found.select("length", "part", "entry", "n", F.posexplode("sums").alias("pos", "x")).groupBy("length", "part", "entry", "pos")
    out = {k: b.copy() for k, b in books.items()}
    for r in sums.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")).collect():  # entries x length rows at most
        out[r["length"]][r["entry"], r["part"] * width(r["length"], parts) + r["pos"]] = int(r["x"]) // r["n"]
    return out


def fingerprint(book: np.ndarray, parts: int) -> str:
    """Digest of the components by part, entry and position."""
    w = book.shape[1] // parts
    return hashlib.sha256(",".join(str(v) for part in range(parts) for row in book[:, part * w : part * w + w].tolist() for v in row).encode()).hexdigest()


def coded(books: Books, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = {k: fingerprint(b, parts) for k, b in books.items()}
        for batch in batches:
            rest = [i for i, name in enumerate(batch.schema.names) if name != "ints"]
            for length, at, x in screening.by_length(batch.column("ints")):
                codes, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
                for part, _, entry, distance in _coded(filled(x, parts), books[length], parts):
                    codes[:, part] = entry
                    error += distance
                kept = [batch.column(i).take(pa.array(at)) for i in rest]
                more = [pa.array([c.tobytes().hex() for c in codes]), pa.array(error), pa.array([prints[length]] * len(x))]
                yield pa.RecordBatch.from_arrays([*kept, *more], names=[*(batch.schema.names[i] for i in rest), "code", "error", "codebooks_sha256"])

    return run


def fit(kept: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> Books:
    """Codebooks of a table (id, ints), one for each length of vector; one small job a length, then one job a round."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's number takes two hexadecimal digits")
    books = {}
    for r in kept.select(F.size("ints").alias("length")).distinct().orderBy("length").collect():
        first = kept.filter(F.size("ints") == r["length"]).select("id", "ints").orderBy(F.asc_nulls_last("id"), "ints").limit(entries).collect()
        books[r["length"]] = filled(np.array([x["ints"] for x in first], np.int64).reshape(len(first), r["length"]), parts)
    for _ in range(rounds):
        books = moved(kept, books, parts)
    return books


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """key, code, error, label_error, codebooks_sha256: two hexadecimal digits for each part, and squared distances."""
    for m in (screening, sys.modules[__name__]):
        ship(m)
    stash = Stash(df.sparkSession, "codes")
    kept = stash.keep(screening.kept(df, vector, scale, id=key, label=label), "kept")
    books = fit(kept, parts, entries, rounds)
    types = dict(kept.dtypes)
    schema = f"id {types['id']}, label {types['label']}, code string, error long, codebooks_sha256 string"
    done = stash.keep(kept.mapInArrow(coded(books, parts), schema), "coded")
    # Written, so that the join is planned by the true number of labels, and a hot label's rows are summed before they meet.
    sums = stash.keep(done.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error")), "sums")
    joined = done.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return joined.select(F.col("c.id").alias(key), "c.code", "c.error", "s.label_error", "c.codebooks_sha256")


def decode(code: str, book: np.ndarray, length: int, parts: int = 8, scale: int = 4096) -> np.ndarray:
    """The vector that a code stands for: its entries' components over ``scale``."""
    w = width(length, parts)
    return np.concatenate([book[e, p * w : p * w + w] for p, e in enumerate(bytes.fromhex(code))])[:length] / scale
