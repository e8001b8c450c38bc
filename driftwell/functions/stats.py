"""Tests of samples: medians, chi-square, median test, t tests, failure rates.

Statistics are Column expressions over arrays; only the distribution functions, which Spark lacks, are pandas UDFs. They
increase strictly, so thresholds and ranking can use the statistic itself.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators import selection
from ..operators.aggregates import let
from . import special

#: The chi-square statistic (3 degrees of freedom) whose confidence is 0.999.
CHI2_999 = 16.26623619623813


@F.pandas_udf(DoubleType())
def chi2_confidence(x: pd.Series) -> pd.Series:
    """Distribution function of chi-square with 3 degrees of freedom."""
    return pd.Series(special.chi2_cdf_3(x.fillna(0).to_numpy())).where(x.notna().to_numpy())


@F.pandas_udf(DoubleType())
def t_distribution(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(special.t_cdf(t.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def beta_inverse(c: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(special.beta_quantile(c.to_numpy(float), a.to_numpy(float), b.to_numpy(float)))


def median(values: Column, simple: bool = True, mean_weight: float = 0.0) -> Column:
    """The middle value. Simple: the mean of the middle two. Otherwise the position inside the run of values equal to the
    median counts (from -1/2 to +1/2), and a median that occurs once, of an odd number, is moved towards its neighbours'
    mean by ``mean_weight``. An empty array gives null."""
    return let(F.sort_array(values), lambda s: _median(s, simple, mean_weight))


def _median(s: Column, simple: bool, mean_weight: float) -> Column:
    """The same of a sorted array."""
    n = F.size(s)
    at = lambda i: F.get(s, i.cast("int")).cast("double")
    half = F.floor(n / 2)
    plain = F.when(n % 2 == 1, at(half)).otherwise((at(half - 1) + at(half)) / 2)
    if simple:
        return F.when(n > 0, plain)
    mid = at(half)
    doubles = s.cast("array<double>")
    below, run = F.array_position(doubles, mid) - 1, n - F.size(F.array_remove(doubles, mid))
    inside = mid + (n / 2 - below) / run - F.lit(0.5)
    ends = (at(half - 1) + at(half + 1)) / 2
    single = F.when((n % 2 == 1) & (n > 1), mid * F.lit(1 - mean_weight) + ends * F.lit(mean_weight)).when(n == 1, mid).otherwise(plain)
    apart = (n % 2 == 0) & (at(half - 1) != at(half))
    return F.when(n > 0, F.when(apart, plain).when(run > 1, inside).otherwise(single))


def median_of_group(simple: bool = True, mean_weight: float = 0.0) -> Column:
    """``median`` from the columns that ``selection.medians`` gives for a group of any size."""
    n, before, mid, after, below, run = map(F.col, ("n", "before", "mid", "after", "below", "run"))
    plain = F.when(n % 2 == 1, mid).otherwise((before + mid) / 2)
    if simple:
        return plain
    ends = (before + after) / 2
    single = F.when((n % 2 == 1) & (n > 1), mid * F.lit(1 - mean_weight) + ends * F.lit(mean_weight)).when(n == 1, mid).otherwise(plain)
    apart = (n % 2 == 0) & (before != mid)
    return F.when(n > 0, F.when(apart, plain).when(run > 1, mid + (n / 2 - below) / run - F.lit(0.5)).otherwise(single))


def median_test_of_groups(df: DataFrame, keys: list[str], value: Column, first: Column, interpolate: bool = True, limit: int = selection.LIMIT) -> DataFrame:
    """keys, a, b (counts below and above the pooled median of the rows for which ``first`` holds, and of the others),
    statistic. Groups may have any size: medians by selection, then counts that are summed before the shuffle."""
    found = selection.medians(df, keys, value, limit).select(*keys, median_of_group(not interpolate, 0.5).alias("cut_"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys])
    rows = df.select(*keys, value.cast("double").alias("value_"), first.alias("first_")).alias("r").join(found.alias("m"), same)
    side = lambda inside: counts_around(F.when(inside, F.col("value_")), F.col("cut_"), 1.0 if interpolate else 0.0)
    both = rows.groupBy(*[F.col(f"r.{k}") for k in keys]).agg(side(F.col("first_")).alias("a"), side(~F.col("first_")).alias("b"))
    return both.withColumn("statistic", let(F.struct("a", "b"), lambda s: counts_statistic(s["a"], s["b"])))


def _share(x: Column, cut: Column, resolution: float) -> Column:
    """How much of a value lies below the cut, from 0 to 1."""
    x = x.cast("double")
    if resolution == 0:
        return F.when(x < cut, F.lit(1.0)).when(x > cut, F.lit(0.0)).otherwise(F.lit(0.5))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (cut - x) / F.lit(resolution) + F.lit(0.5)))


def counts_around(value: Column, cut: Column, resolution: float = 1.0) -> Column:
    """``count_partition`` as an aggregate over rows: sums that are taken before the shuffle, so that no group is gathered.
    Missing values count on neither side."""
    below = F.coalesce(F.sum(F.when(value.isNotNull(), _share(value, cut, resolution))), F.lit(0.0))
    return F.struct(below.alias("below"), (F.count(value) - below).alias("above"))


def count_partition(samples: Column, cut: Column, resolution: float = 1.0) -> Column:
    """struct below, above: a value within half a resolution of the cut is split in proportion. Resolution 0 counts a
    value equal to the cut half and half."""
    # The cut goes along with each value, so that it is computed once.
    shares = F.zip_with(samples, F.array_repeat(cut, F.size(samples)), lambda x, c: _share(x, c, resolution))
    below = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    return F.struct(below.alias("below"), (F.size(samples) - below).alias("above"))


def chi_square(observed: Column, expected: Column) -> Column:
    """Sum of (o - e)² / e over two arrays."""
    terms = F.zip_with(observed, expected, lambda o, e: (o - e) * (o - e) / e)
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def median_test_statistic(a: Column, b: Column, interpolate: bool = True) -> Column:
    """Chi-square of both samples' counts below and above the pooled median; 0 with fewer than three values on a side."""
    resolution = 1.0 if interpolate else 0.0
    pooled = median(F.concat(a, b), simple=not interpolate, mean_weight=0.5)
    p, q = count_partition(a, pooled, resolution), count_partition(b, pooled, resolution)
    return counts_statistic(p, q)


def counts_statistic(p: Column, q: Column) -> Column:
    """The same of both samples' counts (struct below, above), which an aggregate may have given."""
    size = lambda s: s["below"] + s["above"]
    half = lambda s: size(s) / F.lit(2.0)
    term = lambda s: (s["below"] - half(s)) * (s["below"] - half(s)) * 2 / half(s)  # noqa: E731  the counts above deviate as much as those below
    return F.when((size(p) < 3) | (size(q) < 3), F.lit(0.0)).otherwise(term(p) + term(q))


def median_test(a: Column, b: Column, interpolate: bool = True) -> Column:
    """struct diff (the statistic), confidence."""
    d = median_test_statistic(a, b, interpolate)
    return F.struct(d.alias("diff"), chi2_confidence(d).alias("confidence"))


def welch(a: Column, b: Column) -> Column:
    """struct confidence, diff (t), df from two summaries; variances are at least 1/12; fewer than two values: zeros."""
    floor = F.lit(1.0 / 12)
    va, vb = F.greatest(a["variance"], floor) / a["count"], F.greatest(b["variance"], floor) / b["count"]
    t = (a["mean"] - b["mean"]) / F.sqrt(va + vb)
    df = (va + vb) * (va + vb) / (va * va / (a["count"] - 1) + vb * vb / (b["count"] - 1))
    few = (a["count"] < 2) | (b["count"] < 2)
    t, df = F.when(few, F.lit(0.0)).otherwise(t), F.when(few, F.lit(1.0)).otherwise(df)
    confidence = F.abs(t_distribution(t, df) - F.lit(0.5)) * 2
    return F.struct(F.when(few, F.lit(0.0)).otherwise(confidence).alias("confidence"), t.alias("diff"), df.alias("df"))


def single_t(x: Column, s: Column) -> Column:
    """struct confidence (one-sided), diff (t) of one value against a summary."""
    few = (s["count"] < 2) | F.coalesce(s["variance"] == 0, F.lit(True))
    t = F.when(few, F.lit(0.0)).otherwise((x - s["mean"]) / F.sqrt(s["variance"]))
    df = F.greatest(s["count"] - 1, F.lit(1.0))
    return F.struct(F.when(few, F.lit(0.0)).otherwise(t_distribution(t, df)).alias("confidence"), t.alias("diff"))


def confident_fail_rate(fail: Column, passed: Column, confidence: float = 0.7) -> Column:
    """The failure rate nearest to 1/2 between the one-sided beta bounds that hold with ``confidence``."""
    one = F.lit(1.0)
    low = F.when(fail == 0, F.lit(0.0)).otherwise(beta_inverse(F.lit(1 - confidence), F.greatest(fail, one), passed + 1.0))
    high = F.when(passed == 0, one).otherwise(beta_inverse(F.lit(confidence), fail + 1.0, F.greatest(passed, one)))
    return F.when(low > 0.5, low).when(high < 0.5, high).otherwise(F.lit(0.5))


def failure_rate(rate: Column, fails: Column, passes: Column, prior: float = 0.01) -> Column:
    """An aggregate over tests: the chance of a real failure, from each test's failure rate and its current results."""
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), rate))
    odds = F.lit(float(np.log(prior / (1 - prior)))) + F.sum((fails - passes) * F.ln((F.lit(1.0) - p) / p))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def failure_odds(rate: Column, fails: Column, passes: Column) -> Column:
    """Chance that a test really fails, from its history's failure rate and counts of current results: every failure adds
    1 - rate, every pass adds rate as evidence."""
    p = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), rate))
    odds = fails * F.ln((F.lit(1.0) - p) / p) + passes * F.ln(p / (F.lit(1.0) - p))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def sample_summary(values: list[float]) -> dict:
    """count, mean, variance of a literal sample (population)."""
    x = np.asarray(values, float)
    return {"count": float(len(x)), "mean": float(x.mean()), "variance": float(x.var())}
