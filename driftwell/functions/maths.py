"""Arithmetic helpers and combination of evidence, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bayesian_add(*p: Column) -> Column:
    """Probabilities combined as independent evidence: the odds multiply. Missing values are skipped."""
    def two(a: Column, b: Column) -> Column:
        both = a * b / (a * b + (F.lit(1.0) - a) * (F.lit(1.0) - b))
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)

    return reduce(two, p)


def strict_bayesian_add(*p: Column) -> Column:
    """The same, null unless every value that is there lies strictly between 0 and 1."""
    inside = reduce(lambda a, b: a & b, [x.isNull() | ((x > 0) & (x < 1)) for x in p])
    return F.when(inside, bayesian_add(*p))


def bayesian_subtract(a: Column, b: Column) -> Column:
    return bayesian_add(a, F.lit(1.0) - b)


def bayesian_sum(p: Column) -> Column:
    """All probabilities of a group combined: an aggregate over log odds, so partial results add up."""
    odds = F.sum(F.ln(p / (F.lit(1.0) - p)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def significant_digits(v: Column, digits: int) -> Column:
    """Rounded to so many significant digits; 0 stays 0."""
    m = F.pow(F.lit(10.0), F.ceil(F.log10(F.abs(v))) - F.lit(digits))
    return F.when(v == 0, F.lit(0.0)).otherwise(F.round(v / m) * m)


def percent(v: Column, decimals: int = 0) -> Column:
    return F.concat(F.call_function("format_number", v * 100, F.lit(f"0.{'0' * decimals}" if decimals else "0")), F.lit("%"))


def floor_to(v: Column, mod: float = 1) -> Column:
    return F.floor(v / mod) * mod


def ceiling_to(v: Column, mod: float = 1) -> Column:
    return F.ceil(v / mod) * mod


def floor_interval(v: Column, interval: float) -> Column:
    return F.floor(v / interval) * interval


def mod(v: Column, m: float) -> Column:
    """Never negative."""
    return F.pmod(v, F.lit(m))


def is_number(v: Column) -> Column:
    return F.coalesce(~F.isnan(v.try_cast("double")), F.lit(False))


def is_integer(v: Column) -> Column:
    x = v.try_cast("double")
    return F.coalesce(x == F.round(x), F.lit(False))


def zero_to_null(v: Column) -> Column:
    return F.nullif(v, F.lit(0))


def alpha_to_zero(v: Column) -> Column:
    return F.coalesce(v.try_cast("double"), F.lit(0.0))


def close_enough(a: Column, b: Column, relative: float = 1e-9) -> Column:
    biggest = F.greatest(F.abs(a), F.abs(b))
    return F.when(biggest == 0, F.lit(True)).otherwise(F.abs(a - b) <= biggest * relative)


def significant_difference(a: Column, b: Column) -> Column:
    """Whether two probabilities differ enough to be told again."""
    edge = a.isin(0.0, 1.0) | b.isin(0.0, 1.0)
    far = ~(a / b).between(0.8, 1.2)
    moved = ~bayesian_subtract(a, b).between(0.3, 0.7)
    return F.coalesce(edge | far | moved, F.lit(False))


def alert_score(severity: Column, confidence: Column) -> Column:
    """-log10 of the chance that it is nothing."""
    return -F.log10(F.lit(1.0) - bayesian_add(severity, F.least(confidence, F.lit(0.999999))))
