"""Medians by selection against sorted lists, with and without narrowing; and the counts of median tests."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions import stats
from driftwell.operators import selection


@pytest.fixture(scope="module")
def data():
    rng = random.Random(6)
    tied = lambda: rng.choice([0.0, 9.0, rng.random()]) if rng.random() < 0.9 else rng.random() * 9
    groups = {"even": [rng.gauss(0, 1) for _ in range(3000)], "tied": [tied() for _ in range(4001)], "two": [float(rng.random() < 0.5) for _ in range(2000)], "one": [5.0] * 1500, "few": [3.0, 1.0, 2.0], "single": [4.0], None: [float(i % 7) for i in range(900)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("few", None), ("few", float("nan")), ("none", None)]
    rng.shuffle(rows)
    return groups, rows


@pytest.mark.parametrize("limit", [selection.LIMIT, 400, 20])
def test_medians(spark, data, limit):
    groups, rows = data
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    got = {r["k"]: r for r in selection.medians(df, ["k"], F.col("v"), limit).collect()}
    assert set(got) == {*groups, "none"} and got["none"]["n"] == 0 and got["none"]["mid"] is None
    for k, vs in groups.items():
        s, n = sorted(vs), len(vs)
        mid = s[n // 2]
        want = (n, s[n // 2 - 1] if n > 1 else None, mid, s[n // 2 + 1] if n > 2 else None, sum(v < mid for v in s), s.count(mid))
        assert tuple(got[k])[1:] == want, k


def test_plan_gathers_no_group(spark, data):
    df = spark.createDataFrame(data[1], "k string, v double")
    plan = selection.medians(df, ["k"], F.col("v"))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("interpolate", [True, False])
@pytest.mark.parametrize("limit", [selection.LIMIT, 50])
def test_median_test(spark, data, interpolate, limit):
    rng = random.Random(2)
    rows = [(k, v, rng.random() < 0.5) for k, v in data[1] if v is not None and not math.isnan(v)]
    df = spark.createDataFrame(rows, "k string, v double, side boolean")
    got = {r["k"]: r["statistic"] for r in stats.median_test_of_groups(df, ["k"], F.col("v"), F.col("side"), interpolate, limit).collect()}
    arrays = df.groupBy("k").agg(F.collect_list(F.when(F.col("side"), F.col("v"))).alias("a"), F.collect_list(F.when(~F.col("side"), F.col("v"))).alias("b"))
    want = {r["k"]: r["x"] for r in arrays.select("k", stats.median_test_statistic(F.col("a"), F.col("b"), interpolate).alias("x")).collect()}
    assert set(got) == set(want) and np.allclose([got[k] for k in got], [want[k] for k in got])
