"""Scans over whole orders: one global order of rows, cut into blocks that are worked on apart.

Rows are range-partitioned by (edges, sort) and numbered from the ranges' counts, so ``pos_`` is a row's place in the order
of the whole table. Blocks are equal stretches of places. What a block needs from outside is small:

- row frames reach ``before`` and ``after`` rows beyond a block, so those rows are copied into it (``window``);
- running aggregates need what came before as one value (``run``); as rows are sorted by their edges, only the first series
  of a block goes on from an earlier one, so there is one such value for each block;
- kernels get a block with its copies as an Arrow table (``kernel``).

No task holds more than a block and no series is bound to one task, however few series there are. Equal places in the
sort keep the order in which the range's task had them.

Where a count shows that no series is longer than a block may be, each series is a block: one shuffle, no copies, nothing
carried (``Series``). Both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType
from pyspark.sql.window import WindowSpec

from .stored import written

#: Fewest and most rows of a block.
LEAST, MOST = 1 << 14, 1 << 18

#: How partial results of a running aggregate are merged, and how a row's own part joins what came before.
MERGE: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, F.sum, lambda a, b: F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))),
    "count": (F.count, F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + b),
    "min": (F.min, F.min, lambda a, b: F.least(a, b)),
    "max": (F.max, F.max, lambda a, b: F.greatest(a, b)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda c: F.last(c, ignorenulls=True), lambda a, b: F.coalesce(b, a)),
}


class Ordered:
    """A table in one order. Methods add columns; ``done`` gives the table back with them."""

    def __init__(self, df: DataFrame, edges: list[Column], sort: list[Column], size: int | None = None) -> None:
        if not sort:
            raise ValueError("an order needs a sort")
        self.names = df.columns
        self.keys = [f"edge{i}_" for i in range(len(edges))]
        keyed = df.withColumns(dict(zip(self.keys, edges, strict=True))) if edges else df
        order = [*map(F.col, self.keys), *sort]
        at = written(keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id()))
        part = F.shiftright("at_", 33).cast("int")
        counts = {r["part"]: r["n"] for r in at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a range
        bases, self.total = [], 0
        for p in range(max(counts, default=0) + 1):
            bases.append(self.total)
            self.total += counts.get(p, 0)
        self.size = size or min(MOST, max(LEAST, -(-self.total // (4 * max(1, len(counts))))))
        place = F.get(F.lit(bases), part) + F.col("at_").bitwiseAND((1 << 33) - 1)
        self.rows = at.withColumn("pos_", place.cast("long")).drop("at_")

    def _own(self, size: int) -> Column:
        return F.floor(F.col("pos_") / F.lit(size)).cast("long")

    def framed(self, before: int, after: int) -> DataFrame:
        """Rows by block, with the copies of up to ``before`` and ``after`` rows from its neighbours (``own_`` is false)."""
        size = max(self.size, before, after)
        mine, place = self._own(size), F.col("pos_") % size
        homes = F.array_compact(F.array(mine, F.when(place >= size - before, mine + 1), F.when(place < after, mine - 1)))
        return self.rows.withColumn("block_", F.explode(homes)).withColumn("own_", F.col("block_") == mine).repartition("block_")

    def spec(self) -> WindowSpec:
        return W.partitionBy("block_", *self.keys).orderBy("pos_")

    def window(self, make: Callable[[WindowSpec], dict[str, Column]], before: int, after: int) -> Ordered:
        """Columns from windows that reach at most that many rows back and ahead."""
        framed = self.framed(before, after)
        self.rows = framed.withColumns(make(self.spec())).filter("own_").drop("block_", "own_")
        return self

    def run(self, name: str, aggregate: str, value: Column) -> Ordered:
        """A running aggregate, from the first row of the series to this one: sum, count, min, max, last."""
        part, merge, join = MERGE[aggregate]
        rows = self.rows.withColumns({"block_": self._own(self.size), "value_": value})
        parts = rows.groupBy("block_", *self.keys).agg(merge_input(aggregate, part), F.min("pos_").alias("first_"))
        carried = merge(F.col("part_")).over(W.partitionBy(*self.keys).orderBy("block_").rowsBetween(W.unboundedPreceding, -1))
        # Only a block's first series goes on from an earlier block.
        carry = parts.withColumn("carry_", carried).filter(F.col("first_") == F.col("block_") * self.size).select("block_", *self.keys, "carry_").alias("c")
        local = part(F.col("value_")).over(W.partitionBy("block_", *self.keys).orderBy("pos_").rowsBetween(W.unboundedPreceding, 0))
        same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in self.keys], F.col("r.block_") == F.col("c.block_"))
        joined = rows.withColumn("local_", local).alias("r").join(carry, same, "left")
        kept = [c for c in rows.columns if c not in ("block_", "value_", name)]
        self.rows = joined.select(*[F.col(f"r.`{c}`") for c in kept], join(F.col("c.carry_"), F.col("r.local_")).alias(name))
        return self

    def kernel(self, run: Callable[[pa.Table], pa.Table], name: str, kind: DataType, before: int, after: int, make: Callable[[WindowSpec], dict[str, Column]] | None = None) -> Ordered:
        """A column, after those that ``make`` gives from windows, from a function of a block in order, its copies included. The function sees ``own_`` and ``fresh_``, which
        marks the first row of a series in the block, and gives back its own rows with the column at the end."""
        framed = self.framed(before, after)
        framed = framed.withColumns(make(self.spec())) if make else framed
        sent = framed.withColumn("fresh_", F.row_number().over(self.spec()) == 1)
        out = StructType([f for f in framed.schema.fields if f.name not in ("block_", "own_", name)] + [StructField(name, kind)])
        self.rows = sent.groupBy("block_").applyInArrow(run, out)
        return self

    def done(self, *more: str) -> DataFrame:
        return self.rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*self.names, *more])])


class Series(Ordered):
    """The same where each series fits a task."""

    def __init__(self, df: DataFrame, edges: list[Column], sort: list[Column]) -> None:
        self.names, self.sort = df.columns, sort
        self.keys = [f"edge{i}_" for i in range(len(edges))]
        self.rows = df.withColumns(dict(zip(self.keys, edges, strict=True)))

    def spec(self) -> WindowSpec:
        return W.partitionBy(*self.keys).orderBy(*self.sort)

    def window(self, make: Callable[[WindowSpec], dict[str, Column]], before: int, after: int) -> Ordered:
        self.rows = self.rows.withColumns(make(self.spec()))
        return self

    def run(self, name: str, aggregate: str, value: Column) -> Ordered:
        self.rows = self.rows.withColumn(name, MERGE[aggregate][0](value).over(self.spec().rowsBetween(W.unboundedPreceding, 0)))
        return self

    def kernel(self, run: Callable[[pa.Table], pa.Table], name: str, kind: DataType, before: int, after: int, make: Callable[[WindowSpec], dict[str, Column]] | None = None) -> Ordered:
        rows = self.rows.withColumns(make(self.spec())) if make else self.rows
        out = StructType([f for f in rows.schema.fields if f.name != name] + [StructField(name, kind)])
        sent = rows.withColumns({"pos_": F.row_number().over(self.spec()), "own_": F.lit(True)}).withColumn("fresh_", F.col("pos_") == 1)
        self.rows = sent.groupBy(*self.keys).applyInArrow(lambda table: run(table).drop_columns(["pos_"]), out)
        return self


def ordered(df: DataFrame, edges: list[Column], sort: list[Column], size: int | None = None) -> Ordered:
    """Blocks of ``size`` rows where one is given, else each series a block if the longest fits one."""
    if size is None and edges:
        longest = df.groupBy(*[e.alias(f"edge{i}_") for i, e in enumerate(edges)]).count().agg(F.max("count")).first()[0]
        if (longest or 0) <= MOST:
            return Series(df, edges, sort)
    return Ordered(df, edges, sort, size)


def merge_input(aggregate: str, part: Callable[[Column], Column]) -> Column:
    """A block's partial result: of the last value, the one with the greatest place."""
    if aggregate == "last":
        return F.max_by("value_", F.when(F.col("value_").isNotNull(), F.col("pos_"))).alias("part_")
    return part(F.col("value_")).alias("part_")
