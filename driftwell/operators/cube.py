"""Cubes: measures over named edges, kept sparse and made dense on demand."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import aggregate


class Cube:
    """``df`` has a row per cell that exists; ``domains`` maps each edge to a frame of its parts or None."""

    def __init__(self, df: DataFrame, domains: dict[str, DataFrame | None], measures: list[str], nulls: dict[str, bool] | None = None) -> None:
        self.df, self.domains, self.measures = df, domains, measures
        self.nulls = nulls or dict.fromkeys(domains, True)

    @property
    def edges(self) -> list[str]:
        return list(self.domains)

    @property
    def columns(self) -> list[str]:
        return [*self.edges, *self.measures]

    def parts(self, edge: str) -> DataFrame:
        """(edge, edge_order): from the domain, else the values that occur, missing last."""
        if (frame := self.domains[edge]) is not None:
            return frame
        from pyspark.sql import Window as W

        # The edge's distinct values number no more than the cube's cells.
        return self.df.select(edge).distinct().withColumn(f"{edge}_order", F.row_number().over(W.orderBy(F.col(edge).asc_nulls_last())) - 1)

    def dense(self, default: dict | None = None, ordered: bool = False) -> DataFrame:
        """A row for every combination of parts; cells that do not exist are missing or the default."""
        parts = [self.parts(e) if ordered else self.parts(e).select(e) for e in self.edges]
        grid = reduce(lambda a, b: a.crossJoin(b), parts).alias("g")
        on = reduce(lambda a, b: a & b, [F.col(f"g.{e}").eqNullSafe(F.col(f"c.{e}")) for e in self.edges])
        out = grid.join(self.df.alias("c"), on, "left")
        fill = default or {}
        keep = [F.col(f"g.{c}") for c in grid.columns]
        return out.select(*keep, *[(F.coalesce(F.col(f"c.{m}"), F.lit(fill[m])) if m in fill else F.col(f"c.{m}")).alias(m) for m in self.measures])

    def select(self, **picks: str) -> Cube:
        """Keep and rename measures: new name = old name."""
        return Cube(self.df.select(*self.edges, *[F.col(v).alias(k) for k, v in picks.items()]), self.domains, list(picks), self.nulls)

    def groupby(self, *edges: str) -> DataFrame:
        """One row per combination of these edges; the remaining edges form a sub-cube, collected as ``cells``."""
        rest = [c for c in self.columns if c not in edges]
        return self.df.groupBy(*edges).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("cells"))

    def slice(self, **where: object) -> Cube:
        """Fix some edges; the others stay."""
        test = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in where.items()])
        rest = {e: d for e, d in self.domains.items() if e not in where}
        return Cube(self.df.filter(test).select(*rest, *self.measures), rest, self.measures, self.nulls)

    def reduce(self, measure: str, how: str, edges: tuple[str, ...] = ()) -> DataFrame:
        """Aggregate a measure over all edges but those named; missing cells and NaN are skipped."""
        c = F.col(measure)
        value = F.when(~F.isnan(c.cast("double")), c)
        rows = self.df.groupBy(*edges) if edges else self.df
        return rows.agg(aggregate(how, value).alias(measure))

    def forall(self, fn) -> DataFrame:
        """A column ``value`` computed from each cell's row."""
        return self.df.withColumn("value", fn(lambda name: F.col(name)))

    def pivot(self, row: str, column: str, measure: str, values: list) -> DataFrame:
        return self.df.groupBy(row).pivot(column, values).agg(F.first(measure))

    def scalar(self) -> Column:
        """A cube without edges is a value."""
        if self.edges:
            raise ValueError("only a cube without edges is a value")
        return self.df.select(self.measures[0]).scalar()

    def filter(self, where: Column) -> Cube:
        """The cells for which a condition on edges and measures holds."""
        return Cube(self.df.filter(where), self.domains, self.measures, self.nulls)

    # Arithmetic ---------------------------------------------------------------------------------------------------
    def combine(self, other: Cube | float, fn: Callable[[Column, Column], Column], name: str | None = None, default: float | None = None) -> Cube:
        """A cube of ``fn`` of both cubes' single measures, over the edges of both.

        Cells are matched on the edges that both have, missing parts with missing ones; a cube with fewer edges counts for all
        parts of the others. Where only one cube has a cell the other's value is ``default``, and without one there is no
        cell. Cubes that share no edge are refused, but for values, which have no edges. The smaller cube is broadcast where
        Spark finds it small enough.
        """
        (mine,) = self.measures
        name = name or mine
        if not isinstance(other, Cube):
            return Cube(self.df.select(*self.edges, fn(F.col(mine), F.lit(other)).alias(name)), self.domains, [name], self.nulls)
        (theirs,) = other.measures
        shared = [e for e in self.edges if e in other.domains]
        if not shared and self.edges and other.edges:
            raise ValueError("cubes without a common edge")
        a, b = self.df.select(*self.edges, F.col(mine).alias("left_")).alias("a"), other.df.select(*other.edges, F.col(theirs).alias("right_")).alias("b")
        on = reduce(lambda x, y: x & y, [F.col(f"a.{e}").eqNullSafe(F.col(f"b.{e}")) for e in shared], F.lit(True))
        wide_a, wide_b = set(self.edges) >= set(other.edges), set(other.edges) >= set(self.edges)
        how = "inner" if default is None else "full" if wide_a and wide_b else "left" if wide_a else "right" if wide_b else "inner"
        joined = a.join(b, on, how) if shared else a.crossJoin(F.broadcast(b)) if not other.edges else F.broadcast(a).crossJoin(b)  # one row
        edges = [F.coalesce(F.col(f"a.{e}"), F.col(f"b.{e}")).alias(e) if e in shared else F.col(e) for e in [*self.edges, *(e for e in other.edges if e not in shared)]]
        fill = (lambda c: F.coalesce(c, F.lit(default))) if default is not None else (lambda c: c)
        return Cube(joined.select(*edges, fn(fill(F.col("left_")), fill(F.col("right_"))).alias(name)), other.domains | self.domains, [name], other.nulls | self.nulls)

    def __add__(self, other: Cube | float) -> Cube:
        return self.combine(other, lambda a, b: a + b)

    def __sub__(self, other: Cube | float) -> Cube:
        return self.combine(other, lambda a, b: a - b)

    def __mul__(self, other: Cube | float) -> Cube:
        return self.combine(other, lambda a, b: a * b)

    def __truediv__(self, other: Cube | float) -> Cube:
        return self.combine(other, lambda a, b: F.try_divide(a.cast("double"), b.cast("double")))

    __radd__, __rmul__ = __add__, __mul__

    def __rsub__(self, other: float) -> Cube:
        return self.combine(other, lambda a, b: b - a)

    def __rtruediv__(self, other: float) -> Cube:
        return self.combine(other, lambda a, b: F.try_divide(b.cast("double"), a.cast("double")))
