"""Window clauses: aggregates over row frames per edge group, calculated columns, trimmed statistics."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import WindowSpec

from . import aggregates, frames
from .segments import Ordered, Series
from .segments import ordered as ordered_rows


def frame(spec: WindowSpec, low: int | None, high: int | None) -> WindowSpec:
    """The half-open frame [i + low, i + high); a missing bound is open."""
    return spec.rowsBetween(W.unboundedPreceding if low is None else low, W.unboundedFollowing if high is None else high - 1)


def ordered(edges: list[Column], sort: list[Column]) -> WindowSpec:
    spec = W.partitionBy(*edges)
    return spec.orderBy(*sort) if sort else spec


def over(name: str, value: Column | None, window: WindowSpec, middle: float | None = None) -> Column:
    """A window aggregate by name: sum of an empty frame is 0, counts count what is there, stats gives a struct."""
    if name == "stats":
        if middle is not None:
            values = F.collect_list(value).over(window)
            return F.struct(aggregates.trimmed(values, middle).alias("stats"), values.alias("samples"))
        x = value.cast("double")
        sums = [F.count(x).over(window).cast("double").alias("S0")]
        power = x
        for k in range(1, 5):
            sums.append(F.coalesce(F.sum(power).over(window), F.lit(0.0)).alias(f"S{k}"))
            power = power * x
        return aggregates.summary(F.struct(*sums))
    if name in aggregates.OWN:
        return aggregates.OWN[name].of(value, window)
    out = aggregates.aggregate(name, value).over(window) if name not in ("and", "or", "exists") else {"and": F.bool_and, "or": F.bool_or, "exists": lambda c: F.bool_or(c.isNotNull())}[name](value).over(window)
    return F.coalesce(out, F.lit(0)) if name in ("sum", "add", "X1") else out


class RowView:
    """What a calculated column sees: fields of the row, its number, and rows before and after it."""

    def __init__(self, resolve: Callable[[str], Column], spec: WindowSpec, number: Column | None = None) -> None:
        self._resolve, self._spec, self._number = resolve, spec, number
        #: How far the column has looked back and ahead, and whether it has asked for the row's number.
        self.before = self.after = 0
        self.numbered = False

    def __getitem__(self, path: str) -> Column:
        return self._resolve(path)

    @property
    def rownum(self) -> Column:
        self.numbered = True
        return F.row_number().over(self._spec) - 1 if self._number is None else self._number

    def shift(self, path: str, by: int) -> Column:
        """The field ``by`` rows later (earlier if negative); missing beyond the ends."""
        c = self._resolve(path)
        self.before, self.after = max(self.before, -by), max(self.after, by)
        return F.lead(c, by).over(self._spec) if by >= 0 else F.lag(c, -by).over(self._spec)


def apply_window(df: DataFrame, name: str, value: Any, edges: list[Column], sort: list[Column], aggregate: str | None = None, bounds: tuple[int | None, int | None] | None = None, where: Column | None = None, middle: float | None = None, resolve: Callable[[str], Column] = F.col) -> DataFrame:
    """``df`` with one more column. Rows that fail ``where`` do not get it and are in no frame.

    Without edges the rows are one series: frames, running aggregates and shifts are then scans over blocks of the order
    (``segments``), and an aggregate of everything is one row that all rows get. Trimmed statistics of frames always are such
    a scan. Left to one task a series are frames with one open end but for "from the first row to this one".
    """
    if aggregate and bounds and not sort:
        raise ValueError(f"window {name}: a frame needs a sort")
    keys = [*edges, where] if where is not None else edges
    if aggregate == "stats" and middle is not None and sort and bounds and None not in bounds:
        return _trimmed(df, name, value, keys, sort, bounds, middle, where)
    if not edges and (out := _unbroken(df, name, value, keys, sort, aggregate, bounds, where, resolve)) is not None:
        return out
    spec = ordered(keys, sort)
    value = value(RowView(resolve, spec)) if callable(value) and not isinstance(value, Column) else value
    if aggregate:
        low, high = bounds if bounds else (None, None)
        value = over(aggregate, value, frame(spec, low, high) if sort else spec, middle)
    return df.withColumn(name, F.when(where, value) if where is not None else value)


def _guarded(out: DataFrame, name: str, where: Column | None) -> DataFrame:
    return out.withColumn(name, F.when(where, F.col(name))) if where is not None else out


def _trimmed(df: DataFrame, name: str, value: Column, keys: list[Column], sort: list[Column], bounds: tuple[int, int], middle: float, where: Column | None) -> DataFrame:
    low, high = bounds
    samples = F.collect_list(value).over(frame(ordered(keys, sort), low, high))  # left out by the optimiser where it is not asked for
    kind = StructType([StructField(s, DoubleType()) for s in frames.SUMS])
    o = ordered_rows(df.withColumn("input_", value.cast("double")), keys, sort)
    out = o.kernel(frames.trimmed("input_", low, high, middle, "sums_"), "sums_", kind, max(0, -low), max(0, high - 1)).done("sums_")
    both = F.struct(aggregates.summary(F.col("sums_")).alias("stats"), samples.alias("samples"))
    return _guarded(out.withColumn(name, both).drop("sums_", "input_"), name, where)


#: The running aggregate behind a name.
RUNNING = {**dict.fromkeys(("one", "count", "n", "x0"), "count"), **dict.fromkeys(("sum", "add", "x1"), "sum"), **dict.fromkeys(("maximum", "max"), "max"), **dict.fromkeys(("minimum", "min"), "min")}


def plain(name: str, value: Column | None) -> Column:
    """The aggregate of ``over`` over a whole table."""
    if name == "stats":
        return aggregates.summary(aggregates.power_sums(value))
    out = aggregates.aggregate(name, value)
    return F.coalesce(out, F.lit(0)) if name in ("sum", "add", "X1") else out


def _unbroken(df: DataFrame, name: str, value: Any, keys: list[Column], sort: list[Column], aggregate: str | None, bounds: tuple | None, where: Column | None, resolve: Callable) -> DataFrame | None:
    """The window over one series, in blocks; None where it has to be a plain window."""
    shown = df.columns if name in df.columns else [*df.columns, name]
    if aggregate and (not sort or bounds in (None, (None, None))):
        total = (df if where is None else df.filter(where)).agg(plain(aggregate, value).alias("total_"))
        out = df.crossJoin(F.broadcast(total)).withColumn(name, F.col("total_") if where is None else F.when(where, F.col("total_")))  # one row
        return out.select(*[F.col(f"`{c}`") for c in shown])
    if not sort:
        return None
    if not aggregate:
        if not callable(value) or isinstance(value, Column):
            return None
        asked = RowView(resolve, ordered(keys, sort))
        value(asked)
        o = Ordered(df, keys, sort)
        if asked.numbered:
            o.run("number_", "count", F.lit(1))
        make = lambda spec: {name: value(RowView(resolve, spec, (F.col("number_") - 1).cast("int")))}
        return _guarded(o.window(make, asked.before, asked.after).done(*shown), name, where)
    low, high = bounds
    if low is not None and high is not None:
        o = Ordered(df.withColumn("input_", value if value is not None else F.lit(1)), keys, sort)
        make = lambda spec: {name: over(aggregate, F.col("input_"), frame(spec, low, high))}
        return _guarded(o.window(make, max(0, -low), max(0, high - 1)).done(*shown).drop("input_"), name, where)
    if low is None and high == 1 and (kind := RUNNING.get(aggregate.lower())):
        out = Ordered(df, keys, sort).run(name, kind, value if value is not None else F.lit(1)).done(*shown)
        return _guarded(out.withColumn(name, F.coalesce(F.col(name), F.lit(0))) if kind == "sum" else out, name, where)
    return None


def holes(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Half-open gaps (min, max) of the integers [low, high) that the column misses; empty gaps are left out.

    The window runs over the distinct values in ranges, so no task sees more than one range and its neighbour's last value.
    """
    c = F.col(column).cast("long")
    inside = df.select(c.alias("v")).filter((F.col("v") >= low) & (F.col("v") < high)).distinct()
    span = max(1, (high - low) // 1024)
    blocks = inside.withColumn("block", F.floor((F.col("v") - low) / span))
    last = blocks.groupBy("block").agg(F.max("v").alias("last"))
    carry = last.select("block", F.lag("last").over(W.orderBy("block")).alias("carry"))  # at most 1025 rows
    ahead = W.partitionBy("block").orderBy("v")
    before = F.coalesce(F.lag("v").over(ahead), F.col("carry"), F.lit(low - 1))
    inner = blocks.join(F.broadcast(carry), "block").select((before + 1).alias("min"), F.col("v").alias("max"))
    tail = inside.agg(F.coalesce(F.max("v") + 1, F.lit(low)).alias("min"), F.lit(high).cast("long").alias("max"))
    return inner.unionByName(tail).filter("min < max")


def best_of_runs(df: DataFrame, edges: list[str], order: list[str], flag: str, rank: list[Column], out: str = "pass") -> DataFrame:
    """Marks the best row of each run of rows with ``flag``; ``rank`` sorts best first."""
    return best_in(ordered_rows(df, [F.col(e) for e in edges], [F.col(c) for c in order]), flag, rank, out).done(out)


def best_in(o: Ordered, flag: str, rank: list[Column], out: str = "pass") -> Ordered:
    """The same of rows in order. A run is known by the place where it starts: the last change so far."""
    o.rows = o.rows.withColumn("flag_", F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))
    if isinstance(o, Series):
        o.window(lambda spec: {"change_": F.when(~F.col("flag_").eqNullSafe(F.lag("flag_").over(spec)), F.row_number().over(spec))}, 1, 0)
        o.run("run_", "last", F.col("change_"))
        first = F.row_number().over(W.partitionBy(*o.keys, "run_").orderBy(*rank)) == 1
        o.rows = o.rows.withColumn(out, F.col("flag_") & first).drop("flag_", "change_", "run_")
        return o
    o.window(lambda spec: {"change_": F.when(~F.col("flag_").eqNullSafe(F.lag("flag_").over(spec)), F.col("pos_"))}, 1, 0)
    o.run("run_", "last", F.col("change_"))
    best = F.row_number().over(W.partitionBy("run_").orderBy(*rank, "pos_"))
    tops = o.rows.filter("flag_").withColumn("best_", best).filter("best_ = 1").select(F.col("pos_").alias("top_"))
    joined = o.rows.join(tops, F.col("pos_") == F.col("top_"), "left")
    o.rows = joined.withColumn(out, F.col("flag_") & F.col("top_").isNotNull()).drop("flag_", "change_", "run_", "top_")
    return o
