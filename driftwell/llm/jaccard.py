"""N-gram Jaccard join through a token-group matrix.

A document is the set of its distinct word shingles (64-bit hashes). Equal sets are collapsed first; one representative
each goes on. Representatives are partitioned into groups of similar sets (equal bottom-2 sketches), cut into blocks of
about ``BLOCK``. The matrix stores, for each group, the union of its members' prefix tokens, as rows (token, group), in one
global order of tokens. Two sets with n tokens at most that reach the threshold share m of the first
n - ceil(threshold * n) + m tokens; m is a fiftieth of n, or 1. So a query's overlap with a group's stored union bounds what
it can share with any member, and only groups whose bound suffices get the query's set and are opened: their members are
compared exactly with each other and with the queries, and sets that cannot reach the threshold with the members' whole
union are passed over.

Only connectivity is asked for, so the matrix is searched in two ways. First in stars: for each token the groups that
hold it ask its largest one, a number of pairs linear in the matrix; tokens in more than ``CROWD`` sets are dealt into
parts, each a star of its own, whose largest groups meet in a second round. Groups that this connects are one unit from
then on, and only tokens that several units hold remain. Then the exact part: pairs of units with enough common tokens,
queries of the smaller unit bounded against the larger unit's groups one by one, and the groups that qualify opened.

The global order puts frequent tokens last. Frequencies come from a pass over all documents and only steer the work: the
table that is broadcast holds at most ``HOT`` tokens, and a token missing from it counts as rare. Results do not depend
on it.

Edge cases: null and empty texts, and texts of white space, have no shingles and link with nothing; rows with a null id
take part in no link and are their own component (null); repeated rows are equal sets; rows of one id with several texts
link what any of them links; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels
from .common import Stash, ship
from .graph import components
from .kernels import mix, shingles

#: Most tokens in the frequency table, and the count from which a token is worth an entry.
HOT, HOT_FROM = 1 << 19, 12
#: Members of a block, and queries of a task.
BLOCK = 128
#: Sets that hold a token from which on its groups are dealt into several stars.
CROWD = 4096
#: Matrix rows and asking sets of a cell in which queries are bounded.
ENTRIES, ASKERS = 1 << 15, 1 << 11
#: A prefix is longer than needed to share one token by this part of the set, so that it must share as many.
EXTRA = 50
#: Tokens that the counting pass holds at once.
WINDOW = 1 << 21

LIGHT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig1", pa.int64()), ("sig2", pa.int64()), ("grp", pa.int64()), ("prefix", pa.list_(pa.int64()))])
ROLE = pa.schema([("owner", pa.int64()), ("task", pa.int64()), ("query", pa.bool_()), ("doc_id", pa.int64()), ("tokens", pa.binary())])
TOKEN = pa.schema([("tok", pa.int64()), ("n", pa.int64())])
STAR = pa.schema([("tok", pa.int64()), ("grp", pa.int64()), ("centre", pa.int64())])
PAIR = pa.schema([("u1", pa.int64()), ("u2", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def count_locally(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush():
            tok, n = np.unique(np.concatenate(held), return_counts=True)
            more = n > 1
            return pa.RecordBatch.from_arrays([pa.array(tok[more].view(np.int64)), pa.array(n[more])], schema=TOKEN)

        for batch in batches:
            for _, tokens in shingles(batch.column("text"), size):
                held.append(tokens)
                total += len(tokens)
                if total > WINDOW:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def in_order(tokens: np.ndarray, hot: np.ndarray, freq: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` tokens: rare ones by hash, then frequent ones by frequency and hash."""
    if not len(hot):
        return tokens[:most]
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    f = np.where(hot[at] == tokens, freq[at], 0)
    rare = tokens[f == 0]
    if len(rare) >= most:
        return rare[:most]
    rest = f > 0
    order = np.lexsort((tokens[rest], f[rest]))
    return np.concatenate([rare, tokens[rest][order][: most - len(rare)]])


def overlap(n, percent: int):
    """Tokens that the prefixes of two similar sets share at least, by the smaller set's size: a fiftieth, or one."""
    return np.minimum(1 + n // EXTRA, -(-percent * n // 100))


def sketch(size: int, percent: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toks, freq = hot.value
        for batch in batches:
            ids, n, s1, s2, grp, prefixes = batch.column("doc_id"), [], [], [], [], []
            for _, tokens in shingles(batch.column("text"), size):
                k = len(tokens)
                n.append(k)
                mixed = mix(tokens)
                s1.append(int(tokens.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(mixed.sum(dtype=np.uint64).view(np.int64)))
                low = np.sort(mixed)[:2]
                grp.append(int(mix(low[:1] * kernels.BASE + low[-1:])[0].view(np.int64)) if k else 0)
                prefixes.append(in_order(tokens, toks, freq, k + (-percent * k) // 100 + overlap(k, percent) if k else 0).view(np.int64))
            sizes = np.array([0] + [len(p) for p in prefixes]).cumsum().astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(grp, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))], schema=LIGHT
            )

    return run


def sets_for_roles(size: int):
    """From texts with their roles (owner, task, query): the text's set once for each role."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, roles = batch.column("doc_id").to_pylist(), batch.column("roles")
            for row, tokens in shingles(batch.column("text"), size):
                own = roles[row].as_py()
                for i in range(0, len(own), 64):
                    some = own[i : i + 64]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([r[c] for r in some], ROLE.field(c).type) for c in ("owner", "task", "query")), pa.array([ids[row]] * len(some), pa.int64()), pa.array([tokens.tobytes()] * len(some), pa.binary())], schema=ROLE
                    )

    return run


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tok, part, many, grp) sorted by tok and part, the centre of each star first: all but lone groups, with their centre."""
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tok, part, grp = (batch.column(c).to_numpy() for c in ("tok", "part", "grp"))
        new = np.append(last is None or last[:2] != (tok[0], part[0]), (tok[1:] != tok[:-1]) | (part[1:] != part[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(tok)), -1))
        centre = np.where(at < 0, last[2] if last else 0, grp[at])
        last = (tok[-1], part[-1], centre[-1])
        keep = (grp != centre) | (batch.column("many").to_numpy() > 1)
        yield pa.RecordBatch.from_arrays([pa.array(tok[keep]), pa.array(grp[keep]), pa.array(centre[keep])], schema=STAR)


def unit_pairs(percent: int):
    """Rows (tok, lo, hi, unit) sorted by tok: the pairs of units that hold a token and whose sets can be similar by size."""

    def paired(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        _, unit, lo, hi = rows
        fit = (percent * lo[i] <= 100 * hi[j]) & (percent * lo[j] <= 100 * hi[i])
        u, v = unit[i[fit]], unit[j[fit]]
        return np.stack([np.minimum(u, v), np.maximum(u, v)])

    def batch_of(pairs: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(pairs, axis=1)], schema=PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            held = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("tok", "unit", "lo", "hi")])], axis=1)
            edge = np.flatnonzero(np.append(True, held[0, 1:] != held[0, :-1]))
            yield from emitted(held, edge)
            held = held[:, edge[-1] :]
        if held.shape[1]:
            yield from emitted(held, np.array([0, held.shape[1]]))

    def emitted(held: np.ndarray, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs inside each run of one token between neighbouring edges."""
        many = np.diff(edge)
        two = edge[:-1][many == 2]
        out, size = [paired(held, two, two + 1)], len(two)
        for k in np.flatnonzero(many > 2):
            a, b = edge[k], edge[k + 1]
            for i in range(a, b - 1):
                out.append(paired(held, np.full(b - 1 - i, i), np.arange(i + 1, b)))
                size += b - 1 - i
                if size > 1 << 17:
                    yield batch_of(out)
                    out, size = [], 0
        if out:
            yield batch_of(out)

    return run


def qualifying(percent: int):
    """From sets (unit, rep, n, component, prefix) and rows (unit, tok, grp, whole, one, lo, hi) of stored unions: the groups to open for each set."""

    def run(sets: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        owner, doc = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        of_unit = lambda tok, unit: mix(tok.view(np.uint64) + np.asarray(unit, np.int64).view(np.uint64) * kernels.BASE)
        tok = of_unit(rows["tok"].to_numpy(), rows["unit"].to_numpy())
        order = np.argsort(tok)
        tok, rows = tok[order], rows.iloc[order]
        groups, first, own = np.unique(rows["grp"].to_numpy(), return_index=True, return_inverse=True)
        lo, hi, one, whole = (rows[c].to_numpy()[first] for c in ("lo", "hi", "one", "whole"))
        need = overlap(lo, percent)
        for unit, rep, n, component, prefix in zip(sets["unit"], sets["rep"], sets["n"], sets["component"], sets["prefix"], strict=True):
            p = of_unit(np.unique(prefix), [unit])
            a, b = np.searchsorted(tok, p, "left"), np.searchsorted(tok, p, "right")
            size = b - a
            at = np.repeat(a - np.append(0, size.cumsum()[:-1]), size) + np.arange(size.sum())
            shared = np.bincount(own[at], minlength=len(groups))
            hit = (shared >= np.minimum(need, overlap(n, percent))) & (lo * percent <= 100 * n) & (n * percent <= 100 * hi) & ~(whole & (one == component))
            owner.append(groups[hit])
            doc.append(np.full(int(hit.sum()), rep))
        return pd.DataFrame({"owner": np.concatenate(owner), "doc_id": np.concatenate(doc)})

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if percent * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    same = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest index in each set's component, over all pairs of sets."""
    parent = np.arange(len(sets))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    def join(i: int, j: int) -> None:
        i, j = sorted((root(i), root(j)))
        parent[j] = i

    pivots: list[int] = []
    for i, s in enumerate(sets):
        hit = next((p for p in pivots if similar(s, sets[p], percent)), None)
        if hit is not None:
            join(hit, i)
        elif len(pivots) < 8:
            pivots.append(i)
    roots = np.array([root(i) for i in range(len(sets))])
    names, counts = np.unique(roots, return_counts=True)
    if len(names) > 1:
        # All pairs but those inside the largest component, through an index over the sets outside it.
        out = np.flatnonzero(roots != names[counts.argmax()])
        toks, owner = np.concatenate([sets[i] for i in out]), np.repeat(out, [len(sets[i]) for i in out])
        order = np.argsort(toks, kind="stable")
        toks, owner = toks[order], owner[order]
        sizes = np.array([len(s) for s in sets])
        for i, s in enumerate(sets):
            lo, hi = np.searchsorted(toks, s, "left"), np.searchsorted(toks, s, "right")
            n = hi - lo
            if not n.any():
                continue
            at = np.repeat(lo - np.append(0, n.cumsum()[:-1]), n) + np.arange(n.sum())
            who, same = np.unique(owner[at], return_counts=True)
            for j in who[100 * same >= percent * (len(s) + sizes[who] - same)]:
                join(i, int(j))
        roots = np.array([root(i) for i in range(len(sets))])
    return roots


def open_group(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["query", "doc_id"], kind="stable").drop_duplicates(["doc_id", "tokens"])
        sets = [np.frombuffer(t, np.uint64) for t in frame["tokens"]]
        ids, query = frame["doc_id"].to_numpy(), frame["query"].to_numpy()
        members = [s for s, q in zip(sets, query, strict=True) if not q]
        if not members:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        union = np.unique(np.concatenate(members))
        keep = [
            i
            for i, s in enumerate(sets)
            if not query[i] or 100 * int((union[np.minimum(np.searchsorted(union, s), len(union) - 1)] == s).sum()) >= percent * len(s)
        ]
        roots = link([sets[i] for i in keep], percent)
        ids = ids[keep]
        far = ids != ids[roots]
        return pd.DataFrame({"a": ids[far], "b": ids[roots[far]]})

    return run


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id: documents link when 100 * intersection >= percent * union."""
    for m in (kernels, sys.modules[__name__]):
        ship(m)
    spark = docs.sparkSession
    stash = Stash(spark, "jaccard")
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = source.select("text").mapInArrow(count_locally(size), _ddl(TOKEN)).groupBy("tok").agg(F.sum("n").alias("n"))
    hot = counted.filter(F.col("n") >= HOT_FROM).orderBy(F.desc("n"), "tok").limit(HOT).toArrow()
    toks, freq = hot.column("tok").to_numpy().view(np.uint64), hot.column("n").to_numpy().astype(np.int32)
    order = np.argsort(toks)
    table = spark.sparkContext.broadcast((toks[order], freq[order]))
    light = stash.keep(source.mapInArrow(sketch(size, percent, table), _ddl(LIGHT)), "light")
    table.destroy()
    sets = light.filter("n > 0 and doc_id is not null")
    reps = stash.keep(sets.groupBy("sig1", "sig2", "n").agg(F.min("doc_id").alias("rep"), F.first("grp").alias("grp")), "reps")
    # Groups are cut into blocks of at most about BLOCK members; blocks of one group meet again through their tokens.
    large = reps.groupBy("grp").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK)
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / BLOCK))
    members = stash.keep(reps.join(large, "grp", "left").select("rep", "n", F.when(F.col("m").isNull(), F.col("grp")).otherwise(F.xxhash64("grp", part)).alias("grp")), "members")
    groups = stash.keep(members.groupBy("grp").agg(F.count("*").alias("m"), F.min("n").alias("lo"), F.max("n").alias("hi")), "groups")

    def opened(queries: DataFrame, owners: DataFrame) -> DataFrame:
        """Edges from opening ``owners`` (owner) for ``queries`` (owner, doc_id); an owner's queries are dealt to several tasks."""
        load = owners.join(queries.groupBy("owner").agg(F.ceil(F.count("*") / BLOCK).alias("tasks")), "owner", "left").select("owner", F.coalesce("tasks", F.lit(1)).alias("tasks"))
        asks = queries.join(load, "owner").select("owner", F.pmod(F.xxhash64("doc_id"), "tasks").alias("task"), "doc_id", F.lit(True).alias("query"))
        own = members.withColumnRenamed("grp", "owner").join(load, "owner").select(
            "owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("task"), F.col("rep").alias("doc_id"), F.lit(False).alias("query")
        )
        roles = own.unionByName(asks).groupBy("doc_id").agg(F.collect_list(F.struct("owner", "task", "query")).alias("roles"))
        sets = source.join(roles, "doc_id").mapInArrow(sets_for_roles(size), _ddl(ROLE))
        return sets.groupBy("owner", "task").applyInPandas(open_group(percent), "a long, b long")

    def centred(rows: DataFrame) -> DataFrame:
        """tok, grp, centre from (tok, part, many, m, grp): stars around the largest group of each token's part."""
        return rows.repartition("tok", "part").sortWithinPartitions("tok", "part", F.desc("m"), "grp").mapInArrow(stars, _ddl(STAR))

    def asking(rows: DataFrame) -> DataFrame:
        """owner, asks: each group asks the centre with which it shares most tokens, if their sizes allow for similar sets."""
        shared = rows.filter("grp <> centre").groupBy("grp", "centre").agg(F.count("*").alias("shared"))
        sized = shared.join(groups.select("grp", "lo", "hi"), "grp").join(groups.select(F.col("grp").alias("centre"), "m", F.col("lo").alias("lo2"), F.col("hi").alias("hi2")), "centre")
        fit = (F.col("lo") * percent <= F.col("hi2") * 100) & (F.col("lo2") * percent <= F.col("hi") * 100)
        return sized.filter(fit).groupBy("grp").agg(F.max(F.struct("shared", "m", "centre")).alias("best")).select(F.col("best.centre").alias("owner"), F.col("grp").alias("asks"))

    def joined(edges: DataFrame) -> DataFrame:
        return members.join(edges, members["rep"] == edges["node"], "left").select("grp", "rep", "n", F.coalesce("component", "rep").alias("component"))

    def units() -> DataFrame:
        """grp, one, unit: groups whose members are connected are one unit with all such groups of their component."""
        least, most = F.min("component"), F.max("component")
        return placed.groupBy("grp").agg(F.when(least == most, least).alias("one")).withColumn("unit", F.when(F.col("one").isNotNull(), F.xxhash64("one")).otherwise(F.xxhash64("grp", F.lit(1))))

    many = F.ceil(F.col("count") / CROWD)
    crowded = spark.createDataFrame([(int(t), int(n)) for t, n in zip(toks.view(np.int64)[freq > CROWD], freq[freq > CROWD], strict=True)], "tok long, count long").select("tok", many.alias("many"))
    in_parts = lambda rows, grp: rows.join(F.broadcast(crowded), "tok", "left").withColumn("many", F.coalesce("many", F.lit(1))).withColumn("part", F.pmod(F.xxhash64(grp), "many"))
    listed = light.select("doc_id", "prefix").join(members, F.col("doc_id") == F.col("rep")).join(groups.select("grp", "m"), "grp").select("grp", "m", F.explode("prefix").alias("tok"))
    star = stash.keep(centred(in_parts(listed, "grp")), "star")
    matrix = star.select("tok", "grp").union(star.select("tok", F.col("centre").alias("grp"))).distinct()
    best = stash.keep(asking(star), "best")
    queries = members.join(best, members["grp"] == best["asks"]).select("owner", F.col("rep").alias("doc_id"))
    owners = groups.filter("m > 1").select(F.col("grp").alias("owner")).union(best.select("owner")).distinct()
    edges = components(stash.keep(opened(queries, owners), "first_links"), stash, "first")
    placed = stash.keep(joined(edges), "placed")
    if (freq > CROWD).any():
        # The parts of crowded tokens meet: of each unit the largest group.
        tops = matrix.join(F.broadcast(crowded), "tok").join(units(), "grp").join(groups.select("grp", "m"), "grp").groupBy("tok", "unit").agg(F.max(F.struct("m", "grp")).alias("top"))
        again = stash.keep(asking(centred(tops.select("tok", F.lit(0).alias("part"), F.lit(1).alias("many"), "top.m", "top.grp"))), "best_again")
        more = opened(members.join(again, members["grp"] == again["asks"]).select("owner", F.col("rep").alias("doc_id")), again.select("owner").distinct())
        edges = components(edges.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), stash, "again")
        placed = stash.keep(joined(edges), "placed_again")

    # The exact part: tokens that several units hold.
    named = stash.keep(units().join(groups, "grp"), "units")
    entries = matrix.join(named.select("grp", "unit", F.col("one").isNotNull().alias("whole"), F.coalesce("one", F.lit(0)).alias("one"), "lo", "hi"), "grp")
    several = entries.groupBy("tok").agg(F.min("unit").alias("u"), F.max("unit").alias("v")).filter("u <> v").select("tok")
    rest = stash.keep(entries.join(several, "tok"), "rest")
    sizes = named.groupBy("unit").agg(F.sum("m").alias("m"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    held = rest.select("tok", "unit").distinct().join(sizes, "unit").repartition("tok").sortWithinPartitions("tok", "unit")
    pairs = held.select("tok", "unit", "lo", "hi").mapInArrow(unit_pairs(percent), _ddl(PAIR)).groupBy("u1", "u2").agg(F.count("*").alias("shared"))
    both = pairs.join(sizes.select(F.col("unit").alias("u1"), F.col("m").alias("m1"), F.col("lo").alias("lo1")), "u1").join(sizes.select(F.col("unit").alias("u2"), F.col("m").alias("m2"), F.col("lo").alias("lo2")), "u2")
    need = lambda n: F.least(1 + F.floor(n / EXTRA), F.ceil(n * percent / 100))  # noqa: E731  as overlap()
    first = F.col("m1") <= F.col("m2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    directed = both.filter(F.col("shared") >= need(F.least("lo1", "lo2"))).select(pick("u1", "u2").alias("asks"), pick("u2", "u1").alias("unit"))
    # Each set of the asking unit against the stored unions of the other unit's groups, in cells of bounded size.
    askers = stash.keep(placed.join(named.select("grp", F.col("unit").alias("asks")), "grp").join(directed, "asks").select("rep", "n", "component", "unit"), "askers")
    loads = rest.groupBy("unit").agg(F.ceil(F.count("*") / ENTRIES).alias("parts")).join(askers.groupBy("unit").agg(F.ceil(F.count("*") / ASKERS).alias("tasks")), "unit")
    # Small units share cells.
    shared_cells = max(1, rest.count() // ENTRIES * 8)
    cells = stash.keep(loads.withColumn("cell", F.when((F.col("parts") == 1) & (F.col("tasks") == 1), F.pmod(F.xxhash64("unit"), F.lit(shared_cells))).otherwise(F.col("unit"))), "cells")
    several_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    sets = light.select("doc_id", "prefix").join(askers, F.col("doc_id") == F.col("rep")).join(cells, "unit")
    sets = sets.select("cell", several_of("parts").alias("part"), F.pmod(F.xxhash64("rep"), "tasks").alias("task"), "unit", "rep", "n", "component", "prefix")
    rows = rest.join(cells, "unit").select(F.col("cell").alias("cell_"), F.pmod(F.xxhash64("grp"), "parts").alias("part"), several_of("tasks").alias("task"), "unit", "tok", "grp", "whole", "one", "lo", "hi")
    cell = ["cell", "part", "task"]
    queries = stash.keep(sets.groupBy(*cell).cogroup(rows.groupBy("cell_", "part", "task")).applyInPandas(qualifying(percent), "owner long, doc_id long"), "queries")
    more = stash.keep(opened(queries, queries.select("owner").distinct()), "more_links")
    found = components(edges.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), stash, "second")
    by_rep = reps.join(found, reps["rep"] == found["node"], "left").select("sig1", "sig2", "n", F.coalesce("component", "rep").alias("component"))
    by_set = light.select("doc_id", "n", "sig1", "sig2").join(by_rep, ["sig1", "sig2", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return by_set.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
