"""Exact medians of groups of any size, without gathering a group.

Values are counted by (key, value), and a window over the counts finds the middle ranks. Groups with more than ``limit`` rows
are first narrowed: a mergeable KLL sketch of the values still in question gives two bounds around the middle rank, rows
below and between them are counted exactly, and the bounds are taken if the wanted ranks lie between; else, or where ties
keep the range wide, the next round asks for other margins. After ``ROUNDS`` rounds what is left is counted as it is, so the
result never depends on the sketch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .stored import written

#: Rows of a group that are counted without narrowing; half the width of the first range of ranks; most rounds.
LIMIT, MARGIN, ROUNDS = 1 << 20, 0.05, 12
#: Quantiles that are read from a sketch.
GRID = 128


def _same(names: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in names])


def _inside(rows: DataFrame, bounds: DataFrame, names: list[str], low: str = "low", high: str = "high") -> DataFrame:
    return rows.alias("r").join(bounds.alias("b"), _same(names, "r", "b")).filter(F.col("v").between(F.col(f"b.{low}"), F.col(f"b.{high}")))


def _narrowed(rows: DataFrame, bounds: DataFrame, names: list[str], limit: int) -> DataFrame:
    """Closer bounds for the groups that need them; the other groups as they are."""
    keys = [F.col(f"r.{k}") for k in names]
    wide = bounds.filter((F.col("inside") > limit) & (F.col("low") < F.col("high")))
    grid = F.lit([i / GRID for i in range(GRID + 1)])
    sketched = _inside(rows, wide, names).groupBy(*keys).agg(F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double("v"), grid).alias("grid"))
    share = (F.col("n") / 2 - F.col("below")) / F.col("inside")
    at = lambda way, to: F.get("grid", to(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share + way * F.col("margin"))) * GRID).cast("int"))
    asked = written(sketched.alias("s").join(wide.alias("b"), _same(names, "s", "b")).select("b.*", at(-1, F.floor).alias("from"), at(1, F.ceil).alias("to")))
    less, between = F.col("v") < F.col("from"), F.col("v").between(F.col("from"), F.col("to"))
    counted = _inside(rows, asked, names).groupBy(*keys).agg(F.count_if(less).alias("less"), F.count_if(between).alias("between"))
    half, start = F.floor(F.col("n") / 2), F.col("below") + F.col("less")
    first, last = F.greatest(half - 1, F.lit(0)), F.least(half + 1, F.col("n") - 1)
    found = (first >= start) & (last < start + F.col("between"))
    better = found & (F.col("between") < F.col("inside"))
    # Ranks outside the range: a wider margin. A range that ties keep wide: a narrower one.
    margin = F.when(~found, F.least(F.col("margin") * 2, F.lit(1.0))).when(F.col("between") * 2 > F.col("inside"), F.col("margin") / 2).otherwise(F.col("margin"))
    pick = lambda new, old: F.when(better, F.col(new)).otherwise(F.col(old))
    closer = counted.alias("c").join(asked.alias("a"), _same(names, "c", "a")).select(
        *[F.col(f"a.{k}") for k in names], "n", pick("from", "low").alias("low"), pick("to", "high").alias("high"),
        F.when(better, start).otherwise(F.col("below")).alias("below"), pick("between", "inside").alias("inside"), margin.alias("margin"),
    )
    rest = bounds.filter((F.col("inside") <= limit) | (F.col("low") >= F.col("high")))
    return written(rest.unionByName(closer))


def medians(df: DataFrame, keys: list[str], value: Column, limit: int = LIMIT) -> DataFrame:
    """keys, n, before, mid, after, below, run: the number of values, those of rank n/2 - 1, n/2 and n/2 + 1 (from 0), how many
    values lie below ``mid`` and how many equal it. Missing values and NaN do not count; a group without values has n = 0."""
    names = [f"key{i}_" for i in range(len(keys))]
    v = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], v.alias("v"))
    sizes = rows.groupBy(*names).agg(F.count("v").alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    if largest <= limit:
        counted = rows.groupBy(*names, "v").agg(F.count("v").alias("c"))
        total, skipped = F.sum("c").over(W.partitionBy(*names)), F.lit(0)
    else:
        inf = F.lit(float("inf"))
        bounds = written(sizes.select(*names, "n", (-inf).alias("low"), inf.alias("high"), F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"), F.lit(MARGIN).alias("margin")))
        for _ in range(ROUNDS):
            if (bounds.filter("low < high").agg(F.max("inside")).first()[0] or 0) <= limit:
                break
            bounds = _narrowed(rows, bounds, names, limit)
        # A group without values keeps one row, as nothing lies between its bounds.
        kept = bounds.alias("b").join(rows.alias("r"), _same(names, "r", "b") & F.col("v").between(F.col("low"), F.col("high")), "left")
        counted = kept.groupBy(*[F.col(f"b.{k}") for k in names], "v", F.col("b.n"), F.col("b.below").alias("skipped")).agg(F.count("v").alias("c"))
        total, skipped = F.col("n"), F.col("skipped")
    upto = F.sum("c").over(W.partitionBy(*names).orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    placed = counted.withColumns({"n_": total, "first_": skipped + upto - F.col("c"), "next_": skipped + upto})
    half = F.floor(F.col("n_") / 2)
    at = lambda rank, c: F.max(F.when((F.col("first_") <= rank) & (rank < F.col("next_")), F.col(c)))
    out = placed.groupBy(*names).agg(
        F.max("n_").alias("n"), at(half - 1, "v").alias("before"), at(half, "v").alias("mid"), at(half + 1, "v").alias("after"), at(half, "first_").alias("below"), at(half, "c").alias("run"),
    )
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "n", "before", "mid", "after", "below", "run")
