"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a learned lexicon (words and word beginnings), how near its words stand to the second
person, and rates of capitals, punctuation and obfuscation (digits or marks inside words, repeated characters).

The lexicon and the trees are fitted on a sample of at most ``SAMPLE`` labelled rows, those with the smallest hashes of
their id; a fifth of the sample, not seen by the trees, fits the calibration. Texts stay on the executors: word counts are
summed there, and the driver gets at most ``LEXICON`` entries of a lexicon and one row of features for each sample row. The
model is a few kilobytes and travels with the tasks; every text is scored whole.

Edge cases: null and empty texts have zero features and get the score that the model gives to those; labels that are null
or join no document are not used; an id with both labels counts as 1, an id with several texts stands for its smallest;
without labels of both kinds all scores are 0; a null id has no label, is not held out and is scored like any other; repeated rows get equal scores; other columns are ignored, but for one named
like the score, which is replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import Stash, ship
from .kernels import BASE, chunks, mix, powers, words

#: Most labelled rows that the model is fitted on.
SAMPLE = 12_000
#: Entries of the lexicon, and in how many positive sample rows an entry must occur.
LEXICON, SUPPORT = 4000, 4
#: Length in bytes of the word beginnings that may enter the lexicon.
STEMS = (4, 5, 6)
TREES, DEPTH, RATE, BINS, LEAF = 60, 3, 0.2, 32, 8
#: Second-person words of the languages that the tables hold.
SECOND_PERSON = ("you", "your", "yours", "yourself", "ur", "u", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "tú", "usted", "ustedes", "ti", "tus")
NEAR = 5
FEATURES = ("words", "lexicon", "strong", "you", "near_you", "capitals", "shouting", "punctuation", "exclamation", "odd_inside", "repeats", "digits_inside")


def word_keys(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """(hash of each word without its punctuation, hashes of its beginnings, first word of each text, start bytes)."""
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    letter = ((low >= 97) & (low <= 122)) | (low >= 128) | ((low >= 48) & (low <= 57))
    clean = np.where(letter, low, np.uint8(32))
    hashes, bounds, starts = words(clean, offsets, lower=False)
    n, ends = len(clean), None
    stems = []
    if len(starts):
        ink = np.append(clean, 32) != 32
        gone = np.flatnonzero(~ink)
        ends = gone[np.searchsorted(gone, starts)]
        # A word ends with its text even where no blank follows.
        ends = np.minimum(ends, offsets[np.searchsorted(offsets, starts, "right")])
        p = powers(max(STEMS))
        padded = np.append(clean, np.zeros(max(STEMS), np.uint8)).astype(np.uint64)
        for k in STEMS:
            h = np.zeros(len(starts), np.uint64)
            for j in range(k):
                h += (padded[starts + j] + np.uint64(1)) * p[j]
            stems.append(np.where(ends - starts >= k, mix(h * BASE + np.uint64(k)), np.uint64(0)))
    else:
        stems = [np.zeros(0, np.uint64) for _ in STEMS]
    return hashes, stems, bounds, starts


def _known(names: tuple[str, ...]) -> np.ndarray:
    raw = np.frombuffer(" ".join(names).encode(), np.uint8)
    return np.unique(words(raw, np.array([0, len(raw)]), lower=False)[0])


def _in(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_) or not len(x):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, toxic, part): for each hash of a word or beginning, how many texts of each label and part hold it."""
    for batch in batches:
        cell = 2 * batch.column("part").to_numpy() + batch.column("toxic").to_numpy()
        for row, raw, offsets in chunks(batch.column("text")):
            hashes, stems, bounds, _ = word_keys(raw, offsets)
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
            keys, texts = np.concatenate([hashes, *stems]), np.tile(text, 1 + len(STEMS))
            order = np.lexsort([texts, keys])
            keys, texts = keys[order], texts[order]
            new = (keys != 0) & np.append(True, (keys[1:] != keys[:-1]) | (texts[1:] != texts[:-1]))[: len(keys)]
            keys, own = keys[new], cell[row + texts[new]]
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
            counts = [np.add.reduceat((own == c).astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for c in range(4)]
            yield pa.RecordBatch.from_pydict({"h": pa.array(keys[first].view(np.int64)), **{f"c{c}": pa.array(n) for c, n in enumerate(counts)}})


def lexicon(counts: DataFrame, pos: Column, neg: Column, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of words and beginnings that mark label 1, and their log odds; ``LEXICON`` entries at most.

    The best supported entries come first: those whose count in label 1 exceeds what label 0 would give by most.
    """
    odds = F.log((pos + 0.5) / F.lit(toxic + 1.0)) - F.log((neg + 0.5) / F.lit(clean + 1.0))
    best = counts.select("h", pos.alias("pos"), odds.alias("odds")).filter((F.col("pos") >= SUPPORT) & (F.col("odds") > 2.0))
    rows = best.orderBy(F.desc(F.col("pos") * F.col("odds")), "h").limit(LEXICON).select("h", "odds").toArrow()
    keys, odds = rows.column("h").to_numpy().view(np.uint64), rows.column("odds").to_numpy()
    order = np.argsort(keys)
    return keys[order], odds[order]


def features(column: pa.Array, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    keys, odds = lexicon
    strong, you = keys[odds > 4.0], _known(SECOND_PERSON)
    out = np.zeros((len(column), len(FEATURES)))
    for row, raw, offsets in chunks(column):
        hashes, stems, bounds, starts = word_keys(raw, offsets)
        rows = slice(row, row + len(offsets) - 1)
        n_bytes, n_words = np.diff(offsets), np.diff(bounds)
        per = lambda mark, b: np.diff(np.append(0, np.cumsum(mark, dtype=np.int64))[b])
        hit = _in(keys, hashes)
        hard = _in(strong, hashes)
        for s in stems:
            hit |= _in(keys, s)
            hard |= _in(strong, s)
        yours = _in(you, hashes)
        n = len(hashes)
        reach = np.append(0, np.cumsum(yours, dtype=np.int64))
        text = np.repeat(np.arange(len(offsets) - 1), n_words)
        at = np.arange(n)
        lo, hi = np.maximum(at - NEAR, bounds[text]), np.minimum(at + NEAR + 1, bounds[text + 1])
        near = hit & (reach[hi] > reach[lo])
        upper = (raw >= 65) & (raw <= 90)
        alpha = upper | ((raw >= 97) & (raw <= 122)) | (raw >= 128)
        digit = (raw >= 48) & (raw <= 57)
        mark = ~alpha & ~digit & (raw > 32)
        inner = np.zeros(len(raw), bool)
        twice, loud = inner.copy(), inner.copy()
        if len(raw) > 2:
            inner[1:-1] = alpha[:-2] & alpha[2:]
            twice[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (raw[2:] > 32)
            loud[1:] = upper[1:] & upper[:-1]
        w, b = np.maximum(n_words, 1), np.maximum(n_bytes, 1)
        columns = (
            np.log1p(n_words), per(hit, bounds) / w, per(hard, bounds) / w, per(yours, bounds) / w, per(near, bounds) / w,
            per(upper, offsets) / b, per(loud, offsets) / b, per(mark, offsets) / b, per(raw == 33, offsets) / b,
            per(mark & inner, offsets) / b, per(twice, offsets) / b, per(digit & inner, offsets) / b,
        )
        out[rows] = np.array(columns).T
    return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> dict:
    """Logistic gradient boosting over histograms; each tree is a complete one of DEPTH levels."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    # A density that is mostly zero needs edges among its positive values too.
    edges = [np.unique(np.concatenate([e, [0.0], np.quantile(p, np.linspace(0, 1, 9)[:-1]) - 1e-12 if len(p := x[x[:, j] > 0, j]) else []])) for j, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    width = max(map(len, edges)) + 2
    start = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    raw, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), int)
        split_f, split_b = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, width)
        for level in range(DEPTH):
            first = 2**level - 1
            best = np.zeros(2**level)
            for j in range(x.shape[1]):
                key = (node - first) * width + binned[:, j]
                G, H, N = (np.bincount(key, v, 2**level * width).reshape(-1, width).cumsum(axis=1) for v in (g, h, np.ones(len(y))))
                gain = G**2 / (H + 1) + (G[:, -1:] - G) ** 2 / (H[:, -1:] - H + 1) - G[:, -1:] ** 2 / (H[:, -1:] + 1)
                gain[(N < LEAF) | (N[:, -1:] - N < LEAF)] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(len(top)), top] > best + 1e-9
                best = np.where(better, gain[np.arange(len(top)), top], best)
                at = np.flatnonzero(better)
                split_f[first + at], split_b[first + at] = j, top[at]
            node = 2 * node + 1 + (binned[np.arange(len(y)), split_f[node]] > split_b[node])
        leaf = node - (2**DEPTH - 1)
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        raw = raw + value[leaf]
        cut = np.array([edges[f][b] if b < len(edges[f]) else np.inf for f, b in zip(split_f, split_b, strict=True)])
        trees.append((split_f, cut, value))
    return {"start": start, "trees": trees}


def margins(model: dict, x: np.ndarray) -> np.ndarray:
    raw = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, cut, value in model["trees"]:
        node = np.zeros(len(x), int)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        raw += value[node - (2**DEPTH - 1)]
    return raw


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (margins, values) to interpolate between, smoothed by one row of each kind a block."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(m), float(m)])
        while len(blocks) > 1 and (blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1] or blocks[-2][3] == blocks[-1][2]):
            s, n, lo, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], hi]
    xs = np.array([t for b in blocks for t in (b[2], b[3])])
    ys = np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks for _ in (0, 1)])
    return xs, np.maximum.accumulate(ys)


def described(lexicons: list) -> Callable:
    """From (k, toxic, part, text): the features under the lexicon that the row's part had no share in, and under the whole one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, text = batch.column("part").to_numpy(), batch.column("text")
            for i in range(0, batch.num_rows, 256):
                some = text.slice(i, 256)
                whole, own = features(some, lexicons[2]), np.zeros((len(some), len(FEATURES)))
                for k in (0, 1):
                    if len(at := np.flatnonzero(part[i : i + 256] == k)):
                        own[at] = features(some.take(pa.array(at)), lexicons[1 - k])
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64())) for x in (own, whole)]
                yield pa.RecordBatch.from_pydict({"k": batch.column("k").slice(i, 256), "toxic": batch.column("toxic").slice(i, 256), "part": batch.column("part").slice(i, 256), "own": lists[0], "whole": lists[1]})

    return run


def scored(model: dict | None, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.zeros(batch.num_rows)
            else:
                text = batch.column("text")
                score = np.concatenate([np.interp(margins(model, features(text.slice(i, 256), model["lexicon"])), *model["isotonic"]) for i in range(0, len(text), 256)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), pa.array(score)], names=[*batch.schema.names, name])

    return run


def fold(key: str) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(key).cast("string")) % 5


def model_from(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> dict | None:
    """Fitted on labelled rows whose fold is not 0. Only word counts and feature rows come to the driver."""
    for m in (kernels, sys.modules[__name__]):
        ship(m)
    stash = Stash(docs.sparkSession, "toxicity")
    some = (
        labels.filter(F.col("toxic").isin(0, 1) & (fold(key) != 0)).groupBy(F.col(key).alias("k")).agg(F.max("toxic").cast("long").alias("toxic"))
        .orderBy(F.xxhash64("k"), "k").limit(sample)
    )
    # Part 2 fits the calibration. Features of rows that chose the lexicon would look too good: parts 0 and 1 score each other.
    part = F.when(F.pmod(F.xxhash64("k", F.lit(1)), F.lit(5)) == 0, 2).otherwise(F.pmod(F.xxhash64("k", F.lit(2)), F.lit(2))).cast("long")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(some), "k").groupBy("k", "toxic").agg(F.min("text").alias("text"))
    rows = stash.keep(texts.select("k", "toxic", part.alias("part"), "text"), "sample")
    n = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    train = [(n.get((0, y), 0) + n.get((1, y), 0)) for y in (0, 1)]
    if not all(train):
        return None
    counted = rows.filter("part < 2").select("text", "toxic", "part").mapInArrow(count_words, "h long, c0 long, c1 long, c2 long, c3 long")
    counts = stash.keep(counted.groupBy("h").agg(*[F.sum(f"c{c}").alias(f"c{c}") for c in range(4)]).filter(f"c1 + c3 >= {SUPPORT}"), "counts")
    c = [F.col(f"c{i}") for i in range(4)]
    lexicons = [lexicon(counts, c[2 * p + 1], c[2 * p], n.get((p, 1), 0), n.get((p, 0), 0)) for p in (0, 1)] + [lexicon(counts, c[1] + c[3], c[0] + c[2], train[1], train[0])]
    found = rows.mapInArrow(described(lexicons), "k long, toxic long, part long, own array<double>, whole array<double>").orderBy("k").toArrow()
    stash.drop("sample", "counts")
    y, part_of = found.column("toxic").to_numpy().astype(float), found.column("part").to_numpy()
    own, whole = (found.column(c).combine_chunks().flatten().to_numpy().reshape(len(y), -1) for c in ("own", "whole"))
    mine, rest = part_of < 2, part_of == 2
    model = fit_trees(own[mine], y[mine]) | {"lexicon": lexicons[2]}
    rest = rest if rest.any() else mine
    model["isotonic"] = fit_isotonic(margins(model, whole[rest]), y[rest])
    return model


def score(docs: DataFrame, model: dict | None, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``; all columns stay but one of that name, which is replaced."""
    for m in (kernels, sys.modules[__name__]):
        ship(m)
    rest = [c for c in docs.columns if c not in (text, name)]
    source = docs.select(*rest, F.col(text).alias("text"))
    schema = ", ".join([f"`{c}` {t}" for c, t in source.dtypes] + [f"`{name}` double"])
    return source.mapInArrow(scored(model, name), schema).withColumnRenamed("text", text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    done = score(docs.select("doc_id", "text"), model_from(docs, labels))
    return done.select("doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
