"""Joins that the language or its reports need beyond equality: bands, latest rows, keys that may be missing, images."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import interval_join


def null_safe(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def band_join(df: DataFrame, value: str, bands: DataFrame, low: str, high: str, width: float, how: str = "left") -> DataFrame:
    """Rows with the bands [low, high) that hold their value. Bands are cut into cells of ``width``, so the join is an
    equi-join on the cell with the bounds as a residual condition, not a nested loop."""
    cell = lambda c: F.floor(c / F.lit(width)).cast("long")
    b = bands.withColumn("cell_", F.explode(F.sequence(cell(F.col(low)), cell(F.col(high))))).alias("b")
    a = df.withColumn("cell_", cell(F.col(value))).alias("a")
    on = (F.col("a.cell_") == F.col("b.cell_")) & (F.col(f"b.{low}") <= F.col(f"a.{value}")) & (F.col(f"a.{value}") < F.col(f"b.{high}"))
    return a.join(b, on, how).drop("cell_")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, fields: list[str]) -> DataFrame:
    """Each left row with the fields of the last right row of its key at or before it: one union and one window."""
    r = F.struct(*[F.col(f) for f in fields])
    none = F.lit(None).cast(right.select(r.alias("r")).schema[0].dataType)
    rest = [c for c in left.columns if c not in (*keys, at)]
    both = left.select(*keys, at, F.struct(*rest).alias("l_"), none.alias("r_"), F.lit(1).alias("side_")).unionByName(
        right.select(*keys, at, F.lit(None).cast(left.select(F.struct(*rest).alias("l")).schema[0].dataType).alias("l_"), r.alias("r_"), F.lit(0).alias("side_"))
    )
    w = W.partitionBy(*keys).orderBy(at, "side_").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("r_", F.last("r_", ignorenulls=True).over(w)).filter("side_ = 1").select(*keys, at, "l_.*", *[F.col(f"r_.{f}").alias(f) for f in fields])


def latest(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key that comes first in ``order``."""
    return df.withColumn("rn_", F.row_number().over(W.partitionBy(*keys).orderBy(order))).filter("rn_ = 1").drop("rn_")


def arg_max(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The same for descending order as an aggregation: partial results are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("r_")).select(*keys, "r_.*")


def image(df: DataFrame, value: str, relation: DataFrame, key: str, target: str) -> DataFrame:
    """Distinct targets of the values in a relation; missing ones are left out."""
    return df.join(relation, df[value] == relation[key]).select(target).filter(F.col(target).isNotNull()).distinct()


def snapshot(records: DataFrame, parts: DataFrame, low: str, high: str, at: str) -> DataFrame:
    """Records whose interval [low, high] holds a partition's start; a missing high is open. For irregular partitions, which
    keep a row without a record where none holds their start. An equi-join on dyadic cells (``intervals``); where only the
    number of records matters, ``intervals.held`` gives it without the pairs."""
    met = interval_join(parts, records, low, high, at)
    bare = parts.join(met.select(F.col(at).alias("met_")).distinct(), F.col(at) == F.col("met_"), "left_anti")
    return met.unionByName(bare.select("*", *[F.lit(None).cast(t).alias(c) for c, t in records.dtypes]))
