"""Suffix-array dedup: remove every byte covered by a 200-byte string that starts anywhere else.

The suffixes of all texts are dealt into buckets so that equal 200-byte prefixes share a bucket: a suffix's bucket is the
smallest-hash 64-gram ("anchor") inside its first 200 bytes. All suffixes with one occurrence of an anchor travel as one
piece of text (its context), five bytes a suffix instead of 200.

1. Anchors that occur once in the corpus have no equal suffixes and go no further.
2. Contexts that are equal as a whole are duplicates; one of each goes on as a partner for the others.
3. Buckets with several distinct contexts are sorted, one block of buckets at a time. Contexts are laid out so that their
   anchors are congruent modulo the period of a difference cover. The suffixes at cover positions are ranked first (block
   ranks, then prefix doubling); the bucket's suffixes are sorted by their first 31 bytes, and ties are resolved by the
   rank of the next cover position. Neighbours in the sorted order are compared over all 200 bytes.
4. The suffixes of a bucket with more than ``CROWD`` contexts are counted by a 128-bit hash of their 200 bytes, in ``SALTS``
   parts a hash, so that no task holds a bucket, or all places of one string.

Edge cases: a null text has no bytes; texts shorter than 200 bytes lose nothing; rows equal in id and text are copies of
each other; a null id is an ordinary value; an empty table gives no rows; other columns are ignored. A text is scanned for
anchors ``SEGMENT`` window starts at a time, but read and cut whole, so it must fit into a task; positions are 32-bit numbers.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import Stash, ship, text_or_empty
from .kernels import BASE, chunks, mix, powers

WIDTH, GRAM = 200, 64
#: A difference cover of the residues modulo 31: every residue is a difference of two of its members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
CROWD = 20_000
SALTS = 1024
#: Window starts of a long text that are scanned at once.
SEGMENT = 1 << 22
#: Suffixes sorted in one block.
BLOCK = 1 << 19
PLACE = np.uint64(28)

ANCHOR = pa.schema([("key", pa.int64()), ("mh", pa.int64()), ("ch", pa.int64()), ("a", pa.int32()), ("o", pa.int32()), ("nw", pa.int32())])
CONTEXT = pa.schema([("mh", pa.int64()), ("key", pa.int64()), ("a", pa.int32()), ("o", pa.int32()), ("nw", pa.int32()), ("done", pa.bool_()), ("bytes", pa.binary())])
SUFFIX = pa.schema([("h0", pa.int64()), ("h1", pa.int64()), ("salt", pa.int32()), ("key", pa.int64()), ("s", pa.int32()), ("done", pa.bool_())])
SPAN = pa.schema([("key", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])
KEPT = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def windows(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...] | None:
    """Runs of window starts with one anchor: (text, first start, anchor, run length, anchor hash, context hash)."""
    n, w = len(raw), width - GRAM + 1
    if n < width:
        return None
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    back = powers(n + 1, inverse)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(n), out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * back[: n - GRAM + 1])
    m = len(grams)
    packed = ((grams >> PLACE) << PLACE) | np.arange(m, dtype=np.uint64)
    padded = np.full(-(-m // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:m] = packed
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: m - w + 1], ahead[w - 1 : m])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    start = np.arange(len(least))
    inside = start + width <= offsets[text + 1]
    start, text, place = start[inside], text[inside], (least[inside] & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    if not len(start):
        return None
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
    run = np.diff(np.append(new, len(start)))
    a, p = start[new], place[new]
    whole = mix((total[a + run - 1 + width] - total[a]) * back[a] + run.astype(np.uint64))
    return text[new], a, p, run, grams[p], whole


def segments(raw: np.ndarray, offsets: np.ndarray, width: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first byte, bytes, offsets): a long text in parts that overlap by a window less one byte, anything else as it is."""
    if len(offsets) > 2 or len(raw) < most + width:
        yield 0, raw, offsets
        return
    for at in range(0, len(raw) - width + 1, most):
        part = raw[at : at + most + width - 1]
        yield at, part, np.array([0, len(part)])


def anchors(width: int, most: int = SEGMENT):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for row, whole, bounds in chunks(batch.column("text")):
                for at, raw, offsets in segments(whole, bounds, width, most):
                    if (found := windows(raw, offsets, width)) is None:
                        continue
                    text, a, p, nw, mh, ch = found
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[row + text]), pa.array(mh.view(np.int64)), pa.array(ch.view(np.int64)), pa.array((at + a - offsets[text]).astype(np.int32)), pa.array((p - a).astype(np.int32)), pa.array(nw.astype(np.int32))],
                        schema=ANCHOR,
                    )

    return run


def per_context(schema: pa.Schema, rows_of: Callable[[int, memoryview, dict], Iterator[tuple]]):
    """From texts and the list of contexts wanted from each: the rows made of each context."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for key, text, wanted in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("wanted"), strict=True):
                raw = memoryview(text.as_py() or b"")
                for c in wanted:
                    rows += rows_of(key, raw, c.as_py())
                    if len(rows) > 4096:
                        yield table(rows)
                        rows = []
            if rows:
                yield table(rows)

    return run


def cut(width: int):
    """The bytes of each context."""
    return per_context(CONTEXT, lambda key, raw, c: iter([(c["mh"], key, c["a"], c["o"], c["nw"], c["done"], bytes(raw[c["a"] : c["a"] + c["nw"] - 1 + width]))]))


def hashed(width: int, salts: int):
    """The suffixes of each context with a hash of their first ``width`` bytes, and a part by place."""

    def rows_of(key: int, raw: memoryview, c: dict) -> Iterator[tuple]:
        for s in range(c["a"], c["a"] + c["nw"]):
            h = hashlib.blake2b(raw[s : s + width], digest_size=16).digest()
            yield int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True), (key + s) % salts, key, s, c["done"]

    return per_context(SUFFIX, rows_of)


def _words(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The PERIOD bytes at each position as four big-endian numbers, least significant first."""
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    out = []
    for k in (24, 16, 8, 0):
        x = np.ascontiguousarray(view[at + k]).view(">u8").ravel().astype(np.uint64)
        out.append(x >> np.uint64(8) if k == 24 else x)
    return out


def _dense(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks from 1 of rows, keys least significant first."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = new.cumsum() + 1
    return rank


def cover_ranks(text: np.ndarray, width: int) -> np.ndarray:
    """At each cover position the rank of its suffix over at least ``width`` bytes; 0 elsewhere."""
    n = len(text)
    at = np.concatenate([np.arange(c, n - 2 * PERIOD, PERIOD) for c in COVER])
    rank = np.zeros(n + 2 * width + PERIOD * 16, np.int64)
    rank[at] = _dense(_words(text, at))
    step = PERIOD
    while step < width:
        rank[at] = _dense([rank[at + step], rank[at]])
        step *= 2
    return rank


def sort_block(pieces: list[np.ndarray], before: np.ndarray, count: np.ndarray, bucket: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, offset in it, has an equal neighbour) of the block's suffixes in sorted order; buckets stay apart."""
    # Pad so that each anchor (``before`` bytes into its piece) sits at a multiple of PERIOD; a zero byte ends each piece.
    sizes = np.array([len(p) for p in pieces])
    starts = np.empty(len(pieces), np.int64)
    at = 0
    for i in range(len(pieces)):
        at += (-(at + before[i])) % PERIOD
        starts[i] = at
        at += int(sizes[i]) + 1
    text = np.zeros(at + 2 * width + 2 * PERIOD, np.uint8)
    for s, p in zip(starts, pieces, strict=True):
        text[s : s + len(p)] = p
    rank = cover_ranks(text, width)
    piece = np.repeat(np.arange(len(pieces)), count)
    offset = np.arange(len(piece)) - np.repeat(np.append(0, count.cumsum()[:-1]), count)
    place = starts[piece] + offset
    cover = np.zeros(2 * PERIOD, bool)
    cover[[c + k for c in COVER for k in (0, PERIOD)]] = True
    ahead = np.array([int(np.flatnonzero(cover[r:])[0]) for r in range(PERIOD)])
    residue = place % PERIOD
    tie = rank[place + ahead[residue]]
    order = np.lexsort([tie, *_words(text, place), residue, bucket[piece]])
    i, j = order[:-1], order[1:]
    maybe = np.flatnonzero((residue[i] == residue[j]) & (bucket[piece[i]] == bucket[piece[j]]) & (piece[i] != piece[j]))
    same = np.zeros(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(text, width)
    for k in range(0, len(maybe), 1 << 16):
        m = maybe[k : k + (1 << 16)]
        m = m[text[place[i[m]] + width - 1] == text[place[j[m]] + width - 1]]
        m = m[(view[place[i[m]]] == view[place[j[m]]]).all(axis=1)]
        same[m] = same[m + 1] = True
    return piece[order], offset[order], same


def repeats(width: int, block: int):
    """Contexts sorted by bucket: the spans of suffixes that have an equal one."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        key, a, o, nw, done, data, mh = (list(x) for x in zip(*rows, strict=True))
        a, nw = np.array(a), np.array(nw)
        ids = np.unique(np.array(mh), return_inverse=True)[1]
        piece, offset, same = sort_block([np.frombuffer(x, np.uint8) for x in data], np.array(o), nw, ids, width)
        same &= ~np.array(done)[piece]
        piece, offset = piece[same], offset[same]
        order = np.lexsort([offset, piece])
        piece, offset = piece[order], offset[order]
        new = np.append(True, (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1))[: len(piece)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(piece)) - 1
        who = piece[first] if len(piece) else piece
        s = a[who] + offset[first] if len(piece) else offset
        e = a[who] + offset[last] + width if len(piece) else offset
        return pa.RecordBatch.from_arrays([pa.array(np.array(key, np.int64)[who]), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], schema=SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bucket: list[tuple] = []
        size, now = 0, None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "a", "o", "nw", "done", "bytes", "mh")]
            for row in zip(*cols, strict=True):
                if row[6] != now:
                    if len(bucket) > 1:
                        held += bucket
                        size += sum(r[3] for r in bucket)
                    bucket, now = [], row[6]
                    if size > block:
                        yield solve(held)
                        held, size = [], 0
                bucket.append(row)
        if len(bucket) > 1:
            held += bucket
        if held:
            yield solve(held)

    return run


def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, doc, text, spans in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), batch.column("spans"), strict=True):
            raw, kept, at, runs = text.as_py() or b"", [], 0, 0
            if spans.is_valid and len(spans):
                # Sorted by start: a span that starts beyond the end so far opens a new run.
                for s, e in sorted((x["s"], x["e"]) for x in spans.as_py()):
                    if s > at or not runs:
                        kept.append(raw[at:s])
                        runs += 1
                    at = max(at, e)
            kept.append(raw[at:])
            left = b"".join(kept)
            rows.append((key, doc, len(raw), len(raw) - len(left), runs, left))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), KEPT, strict=True)], schema=KEPT)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    for m in (kernels, sys.modules[__name__]):
        ship(m)
    stash = Stash(docs.sparkSession, "suffixes")
    t = text_or_empty(text)
    source = docs.select(F.xxhash64(F.col(key), t).alias("key"), F.col(key).cast("long").alias("doc_id"), t.alias("text"))
    places = source.select("key", "text").filter(F.octet_length("text") >= width).mapInArrow(anchors(width), _ddl(ANCHOR))
    # Written, so that both sides of the join are plain exchanges, which adaptive execution can split where an anchor is hot.
    often = stash.keep(places.groupBy("mh").agg(F.count("*").alias("n")).filter("n > 1").select("mh"), "often")
    found = stash.keep(places.join(often, "mh"), "found")
    equal = stash.keep(found.groupBy("mh", "ch").agg(F.count("*").alias("c"), F.min(F.struct("key", "a", "o", "nw")).alias("one")), "equal")
    whole = found.join(equal.filter("c > 1").select("mh", "ch"), ["mh", "ch"]).select("key", F.col("a").alias("s"), (F.col("a") + F.col("nw") - 1 + width).alias("e"))
    mixed = stash.keep(equal.groupBy("mh").agg(F.count("*").cast("int").alias("d")).filter("d > 1"), "mixed")
    def wanted(buckets: DataFrame) -> DataFrame:
        """Texts with the contexts that are wanted from each; one row's contexts suffice where rows are equal in id and text."""
        one = equal.join(buckets, "mh").select("one.key", F.struct("mh", "one.a", "one.o", "one.nw", (F.col("c") > 1).alias("done")).alias("w"))
        return source.select("key", "text").join(one.groupBy("key").agg(F.collect_list("w").alias("wanted")), "key")

    contexts = wanted(mixed.filter(F.col("d") <= crowd)).mapInArrow(cut(width), _ddl(CONTEXT))
    partial = contexts.repartition("mh").sortWithinPartitions("mh", "key", "a").mapInArrow(repeats(width, block), _ddl(SPAN))
    crowded = mixed.filter(F.col("d") > crowd)
    if not crowded.isEmpty():
        # A string is counted in parts, and its places look for their part only, so a string at very many places is no hot key.
        suffixes = stash.keep(wanted(crowded).mapInArrow(hashed(width, SALTS), _ddl(SUFFIX)), "suffixes")
        parts = stash.keep(suffixes.groupBy("h0", "h1", "salt").agg(F.count("*").alias("n")), "parts")
        again = parts.join(parts.groupBy("h0", "h1").agg(F.sum("n").alias("all")).filter("all > 1"), ["h0", "h1"])
        hit = suffixes.filter("not done").join(again, ["h0", "h1", "salt"], "left_semi")
        partial = partial.unionByName(hit.select("key", "s", (F.col("s") + width).alias("e")))
    spans = stash.keep(whole.unionByName(partial).groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "spans")
    stash.drop("often", "found", "equal", "mixed", "suffixes", "parts")
    return source.join(spans, "key", "left").mapInArrow(remove, _ddl(KEPT)).drop("key").withColumnRenamed("doc_id", key)


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
