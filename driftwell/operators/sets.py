"""Set algebra of records by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import null_safe


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` itself; an action fails if a key occurs twice."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"duplicate key {twice[0].asDict()}")
    return df


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.alias("a").join(b.alias("b"), null_safe("a", "b", keys), "left_anti")


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.alias("a").join(b.alias("b"), null_safe("a", "b", keys), "left_semi")


def union(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Records of both; equal records count once, different ones under one key are an error."""
    return check_unique(a.unionByName(b).distinct(), keys)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def ordered_set(df: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values with the place where each came first."""
    return df.groupBy(value).agg(F.min(order).alias(order))


def net_new(new: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return difference(new.dropDuplicates(keys), seen, keys)


def invert(df: DataFrame, key: str, values: str) -> DataFrame:
    """From key → values to value → keys."""
    flat = df.select(F.col(key), F.explode(values).alias("value"))
    return flat.groupBy("value").agg(F.array_sort(F.collect_set(key)).alias("keys"))
