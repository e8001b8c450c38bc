"""Scans in blocks against plain windows: whatever the blocks, the rows are the same; and no task gets a whole series."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwell.alerts import detect
from driftwell.operators import frames, groups, segments, windows
from driftwell.operators.aggregates import trimmed
from driftwell.plans.query import Engine


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = [(i, rng.choice([None, "a", "a", "a", "b"]), rng.choice([None, 1.0, 2.0, rng.random(), 7.5]), rng.randrange(4), i // 9) for i in range(400)]
    return spark.createDataFrame(data, "id long, s string, v double, k int, day long").repartition(5).persist()


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_frames_and_runs(rows, size):
    o = segments.Ordered(rows, [F.col("s")], [F.col("id")], size)
    assert o.total == 400
    o.window(lambda spec: {"back": F.lag("v", 3).over(spec), "sum": F.sum("v").over(windows.frame(spec, -5, 3))}, 5, 2)
    for name in segments.MERGE:
        o.run(f"r_{name}", name, F.col("v"))
    w = W.partitionBy("s").orderBy("id")
    up = w.rowsBetween(W.unboundedPreceding, 0)
    want = rows.withColumns({"back": F.lag("v", 3).over(w), "sum": F.sum("v").over(windows.frame(w, -5, 3)), "r_sum": F.sum("v").over(up), "r_count": F.count("v").over(up), "r_min": F.min("v").over(up), "r_max": F.max("v").over(up), "r_last": F.last("v", True).over(up)})
    rounded = lambda df: listed(df.withColumns({c: F.round(c, 9) for c in ("sum", "r_sum")}))
    assert rounded(o.done("back", "sum", *[f"r_{n}" for n in segments.MERGE])) == rounded(want)


@pytest.mark.parametrize("size", [2, 40, 1000])
@pytest.mark.parametrize("wide", [None, 3])
def test_trimmed_frames(rows, size, wide):
    """Both kernels against the sort of each frame."""
    kind = windows.StructType([windows.StructField(s, windows.DoubleType()) for s in frames.SUMS])
    for low, high, middle in ((-9, 1, 0.6), (-3, 4, 0.5), (2, 6, 1.0), (-4, -1, 0.1)):
        o = segments.Ordered(rows, [F.col("s")], [F.col("id")], size)
        got = o.kernel(frames.trimmed("v", low, high, middle, "x", wide), "x", kind, max(0, -low), max(0, high - 1)).done("x")
        spec = windows.frame(W.partitionBy("s").orderBy("id"), low, high)
        sums = F.struct(*[F.round(f"x.{s}", 9) for s in frames.SUMS])
        want = rows.withColumn("l", F.collect_list("v").over(spec)).withColumn("t", trimmed(F.col("l"), middle))
        a = {r["id"]: (r["x"]["S0"], r["x"]["S1"] / r["x"]["S0"] if r["x"]["S0"] else None) for r in got.collect()}
        for r in want.collect():
            n, mean = a[r["id"]]
            assert n == r["t"]["count"] and (mean is None) == (r["t"]["mean"] is None) and (mean is None or abs(mean - r["t"]["mean"]) < 1e-9)
        assert got.select(sums).count() == 400


def test_sorted_structure():
    rng = random.Random(3)
    held, plain = frames.Sorted(4), []
    for _ in range(2000):
        if plain and rng.random() < 0.45:
            x = rng.choice(plain)
            plain.remove(x)
            held.remove(x)
        else:
            x = rng.choice([rng.random(), float(rng.randrange(5))])
            plain.append(x)
            held.add(x)
        plain.sort()
        low, high = sorted((rng.randint(0, len(plain)), rng.randint(0, len(plain))))
        assert len(held) == len(plain) and np.allclose(held.between(low, high), [sum(v**p for v in plain[low:high]) for p in range(5)])
    assert max(map(len, held.buckets)) <= 8


def test_language_without_edges(rows):
    e = Engine(rows.sparkSession, {"t": rows})
    run = lambda **w: e.run({"from": "t", "select": ["id", "x"], "window": [{"name": "x", **w}]})
    one = W.partitionBy(F.lit(1)).orderBy("id")
    plain = lambda c: listed(rows.select("id", c.alias("x")))
    near = lambda df: listed(df.withColumn("x", F.round("x", 9)))
    cases = (
        (run(value="v", aggregate="sum"), F.lit(rows.agg(F.sum("v")).first()[0])),
        (run(value="v", aggregate="sum", sort="id", range={"min": -4, "max": 2}), F.coalesce(F.sum("v").over(one.rowsBetween(-4, 1)), F.lit(0))),
        (run(value="v", aggregate="max", sort="id", range={"max": 1}), F.max("v").over(one.rowsBetween(W.unboundedPreceding, 0))),
        (run(value="v", aggregate="sum", sort="id", range={"max": 1}), F.coalesce(F.sum("v").over(one.rowsBetween(W.unboundedPreceding, 0)), F.lit(0))),
        (run(value=lambda r: r.shift("v", -2), sort="id"), F.lag("v", 2).over(one)),
        (run(value=lambda r: r.rownum, sort="id"), F.row_number().over(one) - 1),
    )
    for i, (got, want) in enumerate(cases):
        assert near(got) == listed(rows.select("id", F.round(want, 9).alias("x")))
        # What is carried from block to block is one row a block; rows themselves are never sent to one task.
        assert i not in (1, 4) or "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    some = run(value="v", aggregate="count", sort="id", range={"max": 1}, where={"term": {"k": 2}})
    good = F.col("k") == 2
    assert listed(some) == plain(F.when(good, F.count(F.when(good, F.col("v"))).over(one.rowsBetween(W.unboundedPreceding, 0))))


def test_runs_and_best(rows):
    got = groups.runs(rows.select("id", "k"), ["k"], ["id"])
    last, run, want = None, -1, []
    for i, k in sorted((r["id"], r["k"]) for r in rows.collect()):
        run += k != last
        last = k
        want.append((i, k, run))
    assert listed(got) == sorted(want, key=str)
    assert groups.runs(rows.limit(0), ["k"], ["id"]).count() == 0


@pytest.mark.parametrize("size", [3, 50, None])
def test_shifts_whatever_the_blocks(rows, size):
    series = rows.withColumn("v", F.col("v") + F.floor(F.col("id") / 80))
    out = detect.shifts(series, ["s"], ["id"], "v", detect.Rule(window=8, trigger=3.0), "day", size)
    by = {}
    for r in sorted(series.collect(), key=lambda r: r["id"]):
        by.setdefault(r["s"], []).append(r)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 400 and {"past_stats", "future_stats", "statistic", "diff", "diff_percent", "is_diff", "pass", "past_revision", "date_min", "date_max"} <= set(out.columns)
    passed = 0
    for mine in by.values():
        for i, r in enumerate(mine):
            p, f = ([x["v"] for x in xs if x["v"] is not None] for xs in (mine[max(0, i - 8) : i], mine[i : i + 8]))
            stat = 0.0
            if len(p) > 2 and len(f) > 2:
                cut = float(np.median(p + f))
                stat = sum(2 * (sum((x < cut) + 0.5 * (x == cut) for x in s) - len(s) / 2) ** 2 / (len(s) / 2) for s in (p, f))
            g = got[r["id"]]
            assert abs(g["statistic"] - stat) < 1e-9 and g["past_revision"] == (mine[i - 1]["day"] if i else None)
            assert g["date_max"] == mine[min(len(mine), i + 8) - 1]["id"] and g["date_min"] == (mine[max(0, i - 8)]["id"] if i else None)
        i = 0
        while i < len(mine):
            j = i
            while j < len(mine) and got[mine[j]["id"]]["is_diff"] == got[mine[i]["id"]]["is_diff"]:
                j += 1
            run = [got[x["id"]] for x in mine[i:j]]
            best = max(run, key=lambda g: (g["statistic"], abs(g["diff"] or 0), g["id"]))
            assert [g["id"] for g in run if g["pass"]] == ([best["id"]] if run[0]["is_diff"] else [])
            passed += run[0]["is_diff"]
            i = j
    assert passed > 2
