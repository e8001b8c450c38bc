"""Grouping beyond groupBy: runs, chunks, packed groups; bags of counted values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .segments import Ordered
from .stored import stored


def group_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key with its rows as an array in the given order."""
    lead = [F.col(o).alias(f"_{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*lead, F.struct(*df.columns).alias("row"))))
    return df.groupBy(*keys).agg(F.transform(rows, lambda r: r["row"]).alias("rows"))


def runs(df: DataFrame, keys: list[str], order: list[str], within: list[str] | None = None, out: str = "run") -> DataFrame:
    """Numbers runs of equal keys in data order, per ``within``; without it the table is one order, scanned in blocks."""
    key = F.struct(*keys)
    if not within:
        o = Ordered(df, [], [F.col(c) for c in order])
        o.window(lambda spec: {"change_": (~key.eqNullSafe(F.lag(key, 1).over(spec)) & F.lag(F.lit(1), 1).over(spec).isNotNull()).cast("int")}, 1, 0)
        return o.run(out, "sum", F.col("change_")).done(out)
    spec = W.partitionBy(*within).orderBy(*order)
    change = F.when(F.row_number().over(spec) == 1, 0).otherwise((~key.eqNullSafe(F.lag(key).over(spec))).cast("int"))
    return df.withColumn("change_", change).withColumn(out, F.sum("change_").over(spec.rowsBetween(W.unboundedPreceding, 0))).drop("change_")


def chunks(df: DataFrame, size: int, order: list[str], within: list[str] | None = None, out: str = "chunk") -> DataFrame:
    """Numbers chunks of ``size`` rows in data order, per ``within``; no chunk is empty."""
    n = F.row_number().over(W.partitionBy(*(within or [])).orderBy(*order))
    return df.withColumn(out, F.floor((n - 1) / size).cast("long"))


def global_chunks(df: DataFrame, size: int, order: str, ranges: int | None = None, out: str = "chunk") -> DataFrame:
    """Chunks over a whole table: rows are counted per range of the order, so no task sorts all of them.

    ``ranges``: their number, else the session's number of shuffle partitions.
    """
    by = (order,) if ranges is None else (ranges, order)
    spread = stored(df.repartitionByRange(*by).withColumn("range_", F.spark_partition_id()))
    counts = spread.groupBy("range_").agg(F.count(F.lit(1)).alias("n"))
    base = counts.select("range_", (F.sum("n").over(W.orderBy("range_").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    n = F.row_number().over(W.partitionBy("range_").orderBy(order))
    return spread.join(F.broadcast(base), "range_").withColumn(out, F.floor((F.col("base") + n - 1) / size).cast("long")).drop("range_", "base")


def pack_groups(counts: list[tuple], low: int, high: int) -> list[list]:
    """Greedy groups of counted keys, in the order given: a group takes the next key while it holds less than ``low`` or stays
    under ``high`` with it. A key that reaches ``high`` alone is a group all the same."""
    out, now, held = [], [], 0
    for key, n in counts:
        if now and held >= low and held + n >= high:
            out.append(now)
            now, held = [], 0
        now.append(key)
        held += n
    return out + ([now] if now else [])


def bag(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))


def bag_add(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    return a.unionByName(b).groupBy(value).agg(F.sum("n").alias("n"))


def bag_subtract(a: DataFrame, b: DataFrame, value: str, negative: bool = False) -> DataFrame:
    """Counts of a less those of b; at zero a value goes, below zero it stays only with ``negative``."""
    out = a.unionByName(b.withColumn("n", -F.col("n"))).groupBy(value).agg(F.sum("n").alias("n"))
    return out.filter("n <> 0" if negative else "n > 0")


def bag_map(df: DataFrame, value: str, count: str) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(value), F.col(count)))))
