"""Aggregates by name, power sums, and summary statistics in closed form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: Every name of an aggregate, and the expression that it stands for.
BY_NAME: dict[str, Callable[[Column], Column]] = {
    **dict.fromkeys(("one", "count", "N", "X0"), F.count),
    **dict.fromkeys(("sum", "add", "X1"), F.sum),
    **dict.fromkeys(("maximum", "max"), F.max),
    **dict.fromkeys(("minimum", "min"), F.min),
    **dict.fromkeys(("mean", "average", "avg"), F.avg),
    "X2": lambda c: F.sum(c * c),
    **dict.fromkeys(("std", "stddev"), F.stddev_pop),
    **dict.fromkeys(("var", "variance"), F.var_pop),
    "product": lambda c: F.product(c),
    "and": lambda c: F.coalesce(F.bool_and(c), F.lit(True)),
    "or": lambda c: F.coalesce(F.bool_or(c), F.lit(False)),
    "union": lambda c: F.array_sort(F.collect_set(c)),
    "exists": lambda c: F.bool_or(c.isNotNull()),
    "list": lambda c: F.collect_list(c),
}


@dataclass(frozen=True)
class Own:
    """An aggregate of a user: partial aggregates of the value that Spark merges, and the result from them."""

    parts: dict[str, Callable[[Column], Column]]
    end: Callable[[dict[str, Column]], Column]

    def of(self, value: Column, over: WindowSpec | None = None) -> Column:
        found = {k: part(value) for k, part in self.parts.items()}
        return self.end({k: c.over(over) for k, c in found.items()} if over is not None else found)


OWN: dict[str, Own] = {}


def define(name: str, parts: dict[str, Callable[[Column], Column]], end: Callable[[dict[str, Column]], Column]) -> None:
    """Make ``name`` an aggregate of queries, edges and windows. Each part is one built-in aggregate, so that sums are taken
    before the shuffle; a name that exists already is refused."""
    if name in BY_NAME or name in OWN:
        raise ValueError(f"aggregate {name} exists already")
    OWN[name] = Own(parts, end)


def aggregate(name: str, value: Column | None) -> Column:
    """The aggregate of that name; counts without a value count rows. NaN counts as missing in max and min."""
    if name in ("one", "count", "N", "X0") and value is None:
        return F.count(F.lit(1))
    if name in OWN:
        return OWN[name].of(value)
    if name not in BY_NAME:
        raise ValueError(f"unknown aggregate {name}")
    return BY_NAME[name](value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once, where it would otherwise be written out at each use."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def known(c: Column) -> Column:
    """NaN as null, for folds that skip both."""
    return F.nullif(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(float("nan")))


def power_sums(c: Column) -> Column:
    """struct S0..S4: additive and subtractable."""
    x = c.cast("double")
    return F.struct(
        F.count(x).cast("double").alias("S0"), F.coalesce(F.sum(x), F.lit(0.0)).alias("S1"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("S2"),
        F.coalesce(F.sum(x * x * x), F.lit(0.0)).alias("S3"), F.coalesce(F.sum(x * x * x * x), F.lit(0.0)).alias("S4"),
    )


def combine_sums(a: Column, b: Column, sign: int = 1) -> Column:
    return F.struct(*[(a[s] + F.lit(sign) * b[s]).alias(s) for s in ("S0", "S1", "S2", "S3", "S4")])


def summary(s: Column) -> Column:
    """struct count, mean, variance, skew, kurtosis (population, excess) from power sums.

    No rows: all missing but the count. One row: no variance. Rounding below zero counts as zero.
    """
    n = F.nullif(s["S0"], F.lit(0.0))
    mean = s["S1"] / n
    raw = s["S2"] / n - mean * mean
    variance = F.when(s["S0"] > 1, F.greatest(raw, F.lit(0.0)))
    spread = F.nullif(variance, F.lit(0.0))
    third = s["S3"] / n - F.lit(3.0) * mean * s["S2"] / n + F.lit(2.0) * mean * mean * mean
    fourth = s["S4"] / n - F.lit(4.0) * mean * s["S3"] / n + F.lit(6.0) * mean * mean * s["S2"] / n - F.lit(3.0) * mean * mean * mean * mean
    return F.struct(
        s["S0"].alias("count"), mean.alias("mean"), variance.alias("variance"),
        (third / F.pow(spread, F.lit(1.5))).alias("skew"), (fourth / (spread * spread) - F.lit(3.0)).alias("kurtosis"),
    )


def unsummary(t: Column) -> Column:
    """Power sums from struct count, mean, variance, skew, kurtosis; missing moments count as zero."""
    n, m = t["count"].cast("double"), F.coalesce(t["mean"], F.lit(0.0))
    v = F.coalesce(t["variance"], F.lit(0.0))
    third = F.coalesce(t["skew"], F.lit(0.0)) * F.pow(v, F.lit(1.5))
    fourth = (F.coalesce(t["kurtosis"], F.lit(-3.0)) + F.lit(3.0)) * v * v
    return F.struct(
        n.alias("S0"), (n * m).alias("S1"), (n * (v + m * m)).alias("S2"), (n * (third + F.lit(3.0) * m * v + m * m * m)).alias("S3"),
        (n * (fourth + F.lit(4.0) * m * third + F.lit(6.0) * m * m * v + m * m * m * m)).alias("S4"),
    )


def trimmed(values: Column, middle: float) -> Column:
    """Summary of the middle fraction of an array: ceil(n (1 - f) / 2) values go at each end; nothing left: count 0."""
    def of(v: Column) -> Column:
        n = F.size(v)
        off = F.ceil(n * F.lit((1.0 - middle) / 2)).cast("int")
        return F.when(off * 2 < n, F.slice(v, off + 1, F.greatest(n - off * 2, F.lit(0)))).otherwise(F.slice(v, 1, 0))

    def add(held: Column, value: Column) -> Column:
        x = value.cast("double")
        powers = [F.when(x.isNotNull(), F.lit(1.0)), x, x * x, x * x * x, x * x * x * x]
        return F.struct(*[(held[f"S{p}"] + power).alias(f"S{p}") for p, power in enumerate(powers)])

    def sums(kept: Column) -> Column:
        return F.aggregate(kept, F.struct(*[F.lit(0.0).alias(f"S{p}") for p in range(5)]), add)

    return let(let(let(F.sort_array(values), of), sums), summary)


def null_add(*values: Column) -> Column:
    """Sum of the values that are there; null if none is."""
    total = sum((F.coalesce(v, F.lit(0)) for v in values[1:]), F.coalesce(values[0], F.lit(0)))
    return F.when(F.coalesce(*values).isNotNull(), total)
