"""Statistics with golden numbers, and driver-side helpers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions import conversions, jsons, special, stats, strings, templates, times
from driftwell.functions.durations import DAY, WEEK, Duration
from driftwell.operators import aggregates, groups, sets, windows


def test_beta_brackets(spark):
    """Failures, passes, confidence and the bracketed rate."""
    cases = [(0, 1, 0.7, 0.5), (0, 1, 0.99, 0.5), (1, 0, 0.9, 0.5), (0, 2, 0.7, 0.45227744), (1, 1, 0.7, 0.5), (2, 0, 0.7, 0.54772255), (0, 3, 0.7, 0.3305670), (1, 2, 0.7, 0.5), (2, 1, 0.7, 0.5), (3, 0, 0.7, 0.6694329)]
    for fail, passed, c, want in cases:
        row = spark.createDataFrame([(float(fail), float(passed))], "f double, p double").select(stats.confident_fail_rate(F.col("f"), F.col("p"), c)).first()[0]
        assert row == pytest.approx(want, rel=1e-6), (fail, passed, c)


def test_failure_rate_golden(spark):
    """Current failures of both tests, and the chance of a real failure."""
    for a, b, want in ((0, 1, 0.10), (1, 0, 0.000917431), (1, 1, 0.90)):
        df = spark.createDataFrame([(0.10, float(a), 1.0 - a), (0.01, float(b), 1.0 - b)], "p double, f double, ok double")
        assert df.agg(stats.failure_rate(F.col("p"), F.col("f"), F.col("ok"))).first()[0] == pytest.approx(want, rel=1e-6)


def test_distributions():
    assert special.chi2_cdf_3(np.array([16.26623619623813]))[0] == pytest.approx(0.999, abs=1e-9)
    assert special.t_cdf(np.array([0.0, 12.706204736432095, -1.0]), np.array([5.0, 1.0, 2.0])) == pytest.approx([0.5, 0.975, 0.21132486540518708], abs=1e-9)
    assert special.beta_cdf(np.array([0.3]), np.array([2.0]), np.array([3.0]))[0] == pytest.approx(0.3483, abs=1e-9)


def samples(spark, a, b, interpolate=True):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    return df.select(stats.median_test(F.col("a"), F.col("b"), interpolate).alias("t")).select("t.*").first()


def test_median_test_golden(spark):
    ten = lambda n, m: [20.0] * n + [21.0] * m
    assert samples(spark, ten(11, 9), ten(10, 10))["confidence"] < 0.90 and samples(spark, ten(10, 10), ten(9, 11))["confidence"] < 0.90
    assert samples(spark, ten(4, 4), ten(10, 10))["confidence"] < 0.90
    low, high = [float(x) for x in range(500, 510)], [float(x) for x in range(600, 610)]
    first = samples(spark, low, high[:8])["confidence"]
    assert first > 0.997 and samples(spark, low, high[:9])["confidence"] > first
    assert samples(spark, [1.0, 2.0], high)["confidence"] == 0


def test_median_rules(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0, 3.0],), ([1.0, 2.0, 4.0],), ([5.0],), ([],)], "v array<double>")
    plain = [r[0] for r in df.select(stats.median(F.col("v"))).collect()]
    fine = [r[0] for r in df.select(stats.median(F.col("v"), simple=False, mean_weight=0.5)).collect()]
    assert plain == [2.0, 2.0, 5.0, None] and fine == [2.0, 2.25, 5.0, None]


def test_durations():
    d = Duration.parse("2week+3day")
    assert d.milli == 2 * WEEK + 3 * DAY and str(d) == "2week+3day"
    assert (Duration.parse("1month") * 3).month == 3 and Duration.parse("90day") / Duration.parse("week") == pytest.approx(90 / 7)
    assert Duration.parse("10day").floor(Duration.parse("week")).milli == WEEK
    with pytest.raises(ValueError):
        Duration.parse("3 fortnights")


def test_templates():
    t = {"from": "items", "template": "{{name|upper}}={{v|round(digits=2)}}{{..unit}}", "separator": ", "}
    assert templates.expand(t, {"unit": "ms", "items": [{"name": "a", "v": 1234}, {"name": "b", "v": 0.0567}]}) == "A=1200ms, B=0.057ms"
    assert templates.expand("{{x|percent(decimal=1)}} {{t|datetime}} {{gone}}", {"x": 0.256, "t": 0}) == "25.6% 1970-01-01 00:00:00 "
    with pytest.raises(ValueError):
        templates.expand("{{x|__import__('os')}}", {"x": 1})


def test_settings_and_dots():
    text = '{"a.b": 1, // note\n "a.c": {{n}}, "u": "http://x", }'
    assert jsons.loads(text, {"n": 2}, flexible=True, paths=True) == {"a": {"b": 1, "c": 2}, "u": "http://x"}


def test_patch_round_trip():
    import difflib

    a, b = ["one", "two", "three", "four"], ["one", "2", "three", "four", "five"]
    d = [x.rstrip("\n") for x in difflib.unified_diff(a, b, lineterm="", n=1)]
    assert strings.patched(a, d) == b and strings.patched(b, d, reverse=True) == a


def test_packed_values():
    for v in (None, 3, 2.5, "a|b\\p", ["x|y", 1, None], [["\\", "p"]]):
        assert conversions.pipe_decode(conversions.pipe_encode(v)) == v
    p = conversions.pack_integers([*range(10, 60), 70, 5])
    assert (10, 59) in [(lo, hi) for lo, hi in p["ranges"]] or p["ranges"]


def test_json_objects(spark):
    row = spark.createDataFrame([('x {"t": {"a": "}", "b": {"c": 1}}, "n": -2.5e1, "v": [1, 2]}',)], "j string")
    got = row.select(jsons.obj(F.col("j"), "t"), jsons.number(F.col("j"), "n"), jsons.array(F.col("j"), "v"), jsons.string(F.col("j"), "zz")).first()
    assert tuple(got) == ('{"a": "}", "b": {"c": 1}}', -25.0, "[1, 2]", None)


def test_times(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 9, 18),), (dt.datetime(2024, 7, 4, 8),)], "t timestamp")
    got = df.select(times.is_dst(F.col("t")), times.posting_date(F.col("t")), times.floor(F.col("t"), "week")).collect()
    assert [r[0] for r in got] == [False, True]
    assert [r[1] for r in got] == [dt.datetime(2024, 3, 11), dt.datetime(2024, 7, 4)] and got[0][2] == dt.datetime(2024, 3, 3)


def test_groups_sets_holes(spark):
    assert groups.pack_groups([("a", 5), ("b", 3), ("c", 9), ("d", 1)], 8, 10) == [["a", "b"], ["c"], ["d"]]
    df = spark.createDataFrame([(2,), (3,), (7,)], "v int")
    assert sorted(tuple(r) for r in windows.holes(df, "v", 0, 10).collect()) == [(0, 2), (4, 7), (8, 10)]
    assert [tuple(r) for r in windows.holes(df.limit(0), "v", 0, 10).collect()] == [(0, 10)]
    with pytest.raises(ValueError, match="duplicate key"):
        sets.check_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])


def test_own_aggregates(spark):
    name = "mean_of_squares"
    aggregates.define(name, {"x": lambda c: F.sum(c * c), "n": F.count}, lambda p: p["x"] / F.nullif(p["n"], F.lit(0)))
    try:
        df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", None)], "k string, v double")
        got = {r["k"]: r["m"] for r in df.groupBy("k").agg(aggregates.aggregate(name, F.col("v")).alias("m")).collect()}
        assert got == {"a": 5.0, "b": None}
        for taken in (name, "sum"):
            with pytest.raises(ValueError):
                aggregates.define(taken, {}, lambda p: F.lit(0))
    finally:
        del aggregates.OWN[name]


def test_trimmed_frames(spark):
    df = spark.createDataFrame([([5.0, 1.0, 3.0, 100.0, 2.0],), ([1.0],), ([],), ([2.0, 4.0],)], "v array<double>")
    got = [r[0].asDict() for r in df.select(aggregates.trimmed(F.col("v"), 0.6)).collect()]
    assert [g["count"] for g in got] == [3.0, 0.0, 0.0, 0.0]
    assert got[0]["mean"] == pytest.approx(10 / 3) and got[0]["variance"] == pytest.approx(14 / 9)
    whole = df.select(aggregates.trimmed(F.col("v"), 1.0)).collect()
    assert [r[0]["count"] for r in whole] == [5.0, 1.0, 0.0, 2.0] and whole[3][0]["mean"] == 3.0


def test_counts_around_agree_with_arrays(spark):
    df = spark.createDataFrame([(k, float(v % 7)) for k in ("a", "b") for v in range(20)] + [("a", None), ("c", None)], "k string, v double")
    for resolution in (0, 1.0, 2.5):
        by_rows = df.groupBy("k").agg(stats.counts_around(F.col("v"), F.lit(3.2), resolution).alias("c"))
        by_array = df.groupBy("k").agg(F.collect_list("v").alias("v")).select("k", stats.count_partition(F.col("v"), F.lit(3.2), resolution).alias("c"))
        want = {r["k"]: r["c"] for r in by_array.collect()}
        for r in by_rows.collect():
            assert tuple(r["c"]) == pytest.approx(tuple(want[r["k"]]))
