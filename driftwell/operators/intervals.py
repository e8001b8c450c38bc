"""Intervals: joins with irregular points through dyadic cells, counts at such points and over regular parts by sweeps.

A range of points is cut into 2^levels cells. An interval is the disjoint union of at most two dyadic nodes a level, and a
point lies in one node a level, so that "the interval holds the point" is an equality of nodes: an equi-join that Spark can
shuffle, broadcast by size and split by skew, with the bounds as a residual condition. Each pair meets once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .segments import ordered

NODE = "array<struct<level:int,node:long>>"


def nodes(low: Column, high: Column, levels: int) -> Column:
    """The dyadic nodes whose union is the cells [low, high]; none if low > high."""
    start = F.struct(low.cast("long").alias("a"), (high + 1).cast("long").alias("b"), F.array().cast(NODE).alias("out"))

    def step(s: Column, level: Column) -> Column:
        some = s["a"] < s["b"]
        odd = lambda c: some & (c % 2 == 1)
        left = F.when(odd(s["a"]), F.array(F.struct(level.alias("level"), s["a"].alias("node"))))
        a = s["a"] + F.when(odd(s["a"]), 1).otherwise(0)
        right = F.when((a < s["b"]) & (s["b"] % 2 == 1), F.array(F.struct(level.alias("level"), (s["b"] - 1).alias("node"))))
        none = F.array().cast(NODE)
        out = F.concat(s["out"], F.coalesce(left.cast(NODE), none), F.coalesce(right.cast(NODE), none))
        return F.struct(F.shiftright(a, 1).alias("a"), F.when(some, F.shiftright(s["b"], 1)).otherwise(F.lit(-1).cast("long")).alias("b"), out.alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda s: s["out"])


def _number(df: DataFrame, c: str) -> Callable[[Column], Column]:
    return (lambda x: F.unix_micros(x.cast("timestamp")).cast("double")) if dict(df.dtypes)[c] in ("timestamp", "timestamp_ntz", "date") else (lambda x: x.cast("double"))


def interval_join(points: DataFrame, records: DataFrame, low: str, high: str, at: str, open_end: bool = False, levels: int = 12) -> DataFrame:
    """Pairs of a point and a record whose interval [low, high] holds it; with ``open_end`` [low, high). A missing low holds
    nothing, a missing high is open. Columns of both."""
    number = _number(points, at)
    span = points.agg(F.min(number(F.col(at))).alias("least"), F.max(number(F.col(at))).alias("most")).first()
    least, most = (span["least"] or 0.0), (span["most"] if span["most"] is not None else 0.0)
    width = (most - least) / 2**levels or 1.0
    cell = lambda x: F.greatest(F.lit(0), F.least(F.floor((x - least) / width), F.lit(2**levels - 1)))
    lo, hi = number(F.col(low)), F.coalesce(number(F.col(high)), F.lit(most))
    met = records.filter((lo <= most) & (hi >= least))
    marked = met.withColumn("node_", F.explode(nodes(cell(lo), cell(hi), levels))).alias("r")
    level = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level_")
    placed = points.filter(F.col(at).isNotNull()).select("*", level).withColumn("cell_", _shifted(cell(number(F.col(at))))).alias("p")
    same = (F.col("p.level_") == F.col("r.node_.level")) & (F.col("p.cell_") == F.col("r.node_.node"))
    inside = (F.col(f"r.{low}") <= F.col(f"p.{at}")) & (F.col(f"r.{high}").isNull() | ((F.col(f"p.{at}") < F.col(f"r.{high}")) if open_end else (F.col(f"p.{at}") <= F.col(f"r.{high}"))))
    return placed.join(marked, same & inside).select(*[F.col(f"p.`{c}`") for c in points.columns], *[F.col(f"r.`{c}`") for c in records.columns])


def _shifted(cell: Column) -> Column:
    """The cell's node at the row's level."""
    return F.floor(cell / F.pow(F.lit(2.0), F.col("level_"))).cast("long")


def held(points: DataFrame, records: DataFrame, low: str, high: str, at: str) -> DataFrame:
    """at, n: each different point with the number of records whose interval [low, high] holds it, zero included. A missing
    low holds nothing, a missing high is open, a missing point is held by nothing.

    Each record is two changes, added up by their place before the shuffle; a point's number is the running total of all
    changes up to it, in blocks of the whole order. No pair is written, however long the intervals are.
    """
    some = records.filter(F.col(low).isNotNull() & (F.col(high).isNull() | (F.col(low) <= F.col(high))))
    change = lambda c, starts, ends: F.struct(F.col(c).alias("place_"), F.lit(starts).alias("starts_"), F.lit(ends).alias("ends_"), F.lit(False).alias("point_"))
    ends = some.select(F.inline(F.array(change(low, 1, 0), change(high, 0, 1)))).filter("place_ is not null")
    marks = points.select(F.col(at).alias("place_"), F.lit(0).alias("starts_"), F.lit(0).alias("ends_"), F.lit(True).alias("point_"))
    changes = marks.unionByName(ends).groupBy("place_").agg(F.sum("starts_").alias("starts_"), F.sum("ends_").alias("ends_"), F.bool_or("point_").alias("point_"))
    # A record still holds the place of its end.
    total = ordered(changes, [], [F.col("place_")]).run("n", "sum", F.col("starts_") - F.col("ends_")).done("n")
    return total.filter("point_").select(F.col("place_").alias(at), (F.col("n") + F.col("ends_")).alias("n"))


def sweep(df: DataFrame, keys: list[str], first: Column, last: Column, parts: int, sums: dict[str, Column] | None = None) -> DataFrame:
    """keys, part, n and sums of the records whose parts [first, last] hold that part; parts without records are left out.

    Each record is two changes, at its first part and after its last, added up by part before the shuffle; running totals
    over the changes are the counts. Sums of floating-point values are differences of such totals.
    """
    sums = sums or {}
    ends = F.array(F.struct(F.greatest(first, F.lit(0)).cast("long").alias("part"), F.lit(1).alias("way")), F.struct((last + 1).cast("long").alias("part"), F.lit(-1).alias("way")))
    rows = df.filter((first <= last) & (last >= 0) & (first < parts)).select(*keys, *[v.alias(f"sum_{k}") for k, v in sums.items()], F.inline(ends)).filter(F.col("part") < parts)
    changes = rows.groupBy(*keys, "part").agg(F.sum("way").alias("n"), *[F.sum(F.col("way") * F.col(f"sum_{k}")).alias(k) for k in sums])
    order = W.partitionBy(*keys).orderBy("part")
    up = order.rowsBetween(W.unboundedPreceding, 0)
    total = changes.select(*keys, "part", F.lead("part", 1, parts).over(order).alias("next_"), *[F.sum(c).over(up).alias(c) for c in ("n", *sums)])
    return total.filter("n > 0").select(*keys, F.explode(F.sequence(F.col("part"), F.col("next_") - 1)).alias("part"), "n", *sums)
