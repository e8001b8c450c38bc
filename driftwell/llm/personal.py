"""Personal data: generators propose overlapping spans, boosted trees weigh them, calibrated thresholds select.

The four base kinds are found by their forms alone. Everything else a generator proposes (addresses written with "at" and
"dot", telephone numbers without a plus, cards that stand beside other numbers, and so on; ``pii_forms``) is described by its
format and its context, scored by its kind's gradient-boosted trees, calibrated by isotonic regression, and taken where the score
reaches its kind's threshold: the least at which the share of right spans among held-out examples is ``PRECISION``. A span
that overlaps a base span or a better one is not taken.

No table holds labels of personal data. The trees learn from examples that are written by rule (valid and invalid numbers,
names and hosts) into contexts of the corpus: at most ``SAMPLE`` documents with the smallest hashes give ``WINDOWS``
contexts of ``CONTEXT`` characters each, which is all of the corpus that reaches the driver. Every text is searched whole.

Edge cases: a null text is empty; a null id is an ordinary value; repeated rows are reported once each; very long texts are
searched in linear time; a table without words, where no examples can be written, gives base spans only, and an empty table
gives no rows; other columns are ignored by ``report`` and kept by ``redact``.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels, pii_forms, toxicity
from .common import ship, text_or_empty

#: Documents that give contexts, contexts of each, their length, and the fewest examples to learn from.
SAMPLE, WINDOWS, CONTEXT, EXAMPLES = 3000, 4, 160, 16_000
PRECISION = 0.98
SPANS = "array<struct<start:int,end:int,kind:string,score:double>>"


def contexts(docs: DataFrame, key: str, text: str) -> list[str]:
    """Windows at hashed places of the sampled texts, in the order of the hashes."""
    t = F.col("t")
    h = docs.select(text_or_empty(text).alias("t"), F.xxhash64(F.col(key), text_or_empty(text)).alias("h")).filter(F.length("t") > 0)
    cuts = [F.substr(t, (F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.length(t) - CONTEXT, F.lit(1))) + 1).cast("int"), F.lit(CONTEXT)) for i in range(WINDOWS)]
    # Hashes are even: about twice SAMPLE rows lie below the bound, so that tasks send few rows to be merged.
    share = min(1.0, 2 * SAMPLE / max(1, docs.count()))
    while True:
        low = h if share == 1 else h.filter(F.col("h") < int(share * 2**64) - 2**63)
        rows = low.select("h", F.array(*cuts).alias("cuts")).orderBy("h", "cuts").limit(SAMPLE).collect()
        if len(rows) == SAMPLE or share == 1:
            return [c for r in rows for c in r["cuts"]]
        share = min(1.0, 8 * share)


def threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The least score from which on the share of right spans is ``PRECISION`` at least; 2 where there is none."""
    if not len(y):
        return 2.0
    order = np.argsort(-p, kind="stable")
    right, last = np.cumsum(y[order]) / np.arange(1, len(y) + 1), np.append(p[order][1:] != p[order][:-1], True)
    good = np.flatnonzero((right >= PRECISION) & last & (p[order] >= 0.5))
    return float(p[order][good[-1]]) if len(good) else 2.0


def fit(part: np.ndarray, x: np.ndarray, y: np.ndarray) -> dict | None:
    """Trees, calibration and threshold of one kind; None without examples of both labels."""
    mine = part < 3
    if not 0 < y[mine].sum() < mine.sum() or not (part == 3).any():
        return None
    model = toxicity.fit_trees(x[mine], y[mine])
    model["isotonic"] = toxicity.fit_isotonic(toxicity.margins(model, x[part == 3]), y[part == 3])
    model["threshold"] = threshold(calibrated(model, x[part == 4]), y[part == 4])
    return model


def calibrated(model: dict, x: np.ndarray) -> np.ndarray:
    return np.interp(toxicity.margins(model, x), *model["isotonic"])


def taught(found: list[str], seed: int, examples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(part, kind, features, labels) of the candidates of examples written into contexts."""
    rng = random.Random(seed)
    rows = [(n % 5, *r) for n in range(examples) for r in pii_forms.taught(found[n % len(found)], rng)]
    x = np.array([r[1] for r in rows])
    return np.array([r[0] for r in rows]), x[:, : len(pii_forms.ADDED)].argmax(axis=1), x, np.array([float(r[2]) for r in rows])


def model_of(found: list[str]) -> list[dict | None]:
    """A model for each added kind. Three fifths of the examples grow the trees, one calibrates, one sets the threshold."""
    part, kind, x, y = taught(found, 13, max(EXAMPLES, len(found)))
    return [fit(part[kind == k], x[kind == k], y[kind == k]) for k in range(len(pii_forms.ADDED))]


def model_from(docs: DataFrame, key: str = "doc_id", text: str = "text") -> list[dict | None] | None:
    """The models, from contexts of these documents; None without any text."""
    found = contexts(docs, key, text)
    return model_of(found) if found else None


def scores(models: list[dict | None], texts: list[str], spans: list[list]) -> list[np.ndarray]:
    """Calibrated scores of each text's spans; 0 below the kind's threshold."""
    flat = [(t, s) for t, some in zip(texts, spans, strict=True) for s in some]
    x, kind = np.array([pii_forms.features(t, s) for t, s in flat]), np.array([s[2] - len(pii_forms.BASE) for _, s in flat])
    p = np.zeros(len(flat))
    for k, model in enumerate(models):
        at = np.flatnonzero(kind == k)
        if model and len(at):
            q = calibrated(model, x[at])
            p[at] = np.where(q >= model["threshold"], q, 0.0)
    return np.split(p, np.cumsum([len(s) for s in spans])[:-1])


def selected(models: list[dict | None] | None, texts: list[str]) -> list[list[tuple]]:
    """(start, end, kind, score) of each text's spans, by start, then kind; base spans have score 1."""
    runs = [[m.span() for m in pii_forms.DIGITS.finditer(t)] for t in texts]
    bases = [pii_forms.base(t, r) for t, r in zip(texts, runs, strict=True)]
    out = [[(*s, 1.0) for s in b] for b in bases]
    if models is None:
        return out
    offered = []
    for t, r, b in zip(texts, runs, bases, strict=True):
        held = pii_forms.apart(b)
        offered.append([s for s in pii_forms.proposals(t, r) if not pii_forms.covered(s, *held)])
    for mine, spans, p in zip(out, offered, scores(models, texts, offered), strict=True):
        good = sorted((-q, s[0] - s[1], *s) for s, q in zip(spans, p.tolist(), strict=True) if q > 0)
        mine += apart([((s, e, k), -q) for q, _, s, e, k in good])
        mine.sort(key=lambda s: (s[0], s[2]))
    return out


def apart(ranked: list[tuple]) -> list[tuple]:
    """From the best on, spans that overlap no better one. A position is looked up in the blocks of 32 that spans touch."""
    taken: dict[int, list] = {}
    out = []
    for (start, end, kind), score in ranked:
        blocks = range(start // 32, (end - 1) // 32 + 1)
        if all(s >= end or e <= start for b in blocks for s, e in taken.get(b, ())):
            out.append((start, end, kind, score))
            for b in blocks:
                taken.setdefault(b, []).append((start, end))
    return out


def found(models: list[dict | None] | None, name: str) -> Callable:
    """From (..., text): the other columns and the spans of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))
        for batch in batches:
            at = batch.schema.names.index(name)
            rest = [i for i in range(batch.num_columns) if i != at]
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                texts = [t or "" for t in some.column(at).to_pylist()]
                spans = [[{"start": s, "end": e, "kind": pii_forms.KINDS[k], "score": p} for s, e, k, p in mine] for mine in selected(models, texts)]
                yield pa.RecordBatch.from_arrays([*(some.column(j) for j in rest), pa.array(spans, kind)], names=[*(some.schema.names[j] for j in rest), "spans"])

    return run


def cleaned(models: list[dict | None] | None, name: str) -> Callable:
    """From any columns: the same, with each span of the text replaced by ``[kind]``; null texts stay null."""

    def clean(text: str | None, spans: list[tuple]) -> str | None:
        out, at = [], 0
        for start, end, kind, _ in spans:
            if start >= at:
                out += [text[at:start], f"[{pii_forms.KINDS[kind]}]"]
            at = max(at, end)
        return text if not spans else "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(name)
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                texts = some.column(at).to_pylist()
                done = pa.array([clean(t, s) for t, s in zip(texts, selected(models, [t or "" for t in texts]), strict=True)], batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([done if j == at else some.column(j) for j in range(some.num_columns)], schema=batch.schema)

    return run


def _shipped() -> None:
    for m in (kernels, pii_forms, toxicity, sys.modules[__name__]):
        ship(m)


def scan(docs: DataFrame, models: list[dict | None] | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, spans: array of (start, end, kind, score) by start, then by the kinds' order."""
    _shipped()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(found(models, "text"), f"key {dict(rows.dtypes)['key']}, spans {SPANS}").withColumnRenamed("key", key)


def of_kinds(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def written(spans: str, kinds: tuple[str, ...]) -> Column:
    return F.array_join(F.transform(of_kinds(spans, *kinds), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end, joined by commas)."""
    done = scan(docs, model_from(docs))
    counts = [F.size(of_kinds("spans", k)).cast("long").alias(f"n_{k}") for k in pii_forms.BASE]
    return done.select("doc_id", *counts, F.sha2(written("spans", pii_forms.BASE), 256).alias("base_sha256"), written("spans", pii_forms.KINDS).alias("spans"))


def redact(docs: DataFrame, models: list[dict | None] | None, text: str = "text") -> DataFrame:
    """The documents with each span replaced by ``[kind]``; every other character stays. Columns as in ``docs``."""
    _shipped()
    return docs.mapInArrow(cleaned(models, text), docs.schema)
