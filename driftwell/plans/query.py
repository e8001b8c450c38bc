"""The JSON query language: normal form and compilation to a DataFrame.

A query has ``from``, ``select``, ``edges`` (or ``groupby``), ``where``, ``window``, ``sort`` and ``limit``. Windows are
computed first, in order, and see each other's columns; then come the filter, the aggregation or the sort, the selection
and the limit. Nested records are flattened along the one branch that the query names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from ..operators.aggregates import aggregate
from ..operators.cube import Cube
from . import filters
from .dimensions import Dimension, expand
from .domains import Domain
from .paths import Flat, arrays_on, split_path


@dataclass
class Select:
    name: str
    value: Any
    aggregate: str = "none"
    #: Replaces a missing aggregate.
    default: Any = None


@dataclass
class Edge:
    name: str
    value: Any = None
    domain: Domain = field(default_factory=Domain)
    nulls: bool = True
    range: dict | None = None


@dataclass
class Window:
    name: str
    value: Any
    edges: list = field(default_factory=list)
    sort: list = field(default_factory=list)
    aggregate: str | None = None
    middle: float | None = None
    bounds: tuple[int | None, int | None] | None = None
    where: Any = None


@dataclass
class Query:
    source: Any
    select: list[Select]
    edges: list[Edge]
    where: Any
    window: list[Window]
    sort: list[tuple[Any, int]]
    limit: int | None
    #: A single select gives values, a list gives records.
    single: bool = False


def _list(x: Any) -> list:
    return [] if x is None else list(x) if isinstance(x, (list, tuple)) else [x]


def _leaf(path: Any) -> str:
    if not isinstance(path, str):
        return "value"
    names = split_path(path)
    return names[-1] if names else "value"


def parse_select(s: Any) -> Select:
    if isinstance(s, str):
        return Select(_leaf(s) if s not in (".", "*") else s, s)
    value = s.get("value", s.get("name"))
    return Select(s.get("name") or _leaf(value), value, s.get("aggregate", "none"), s.get("default"))


def parse_sort(sort: Any) -> list[tuple[Any, int]]:
    """(field, 1 or -1); keys sorted by 0 or none are left out."""
    out = []
    ways = {1: 1, -1: -1, 0: 0, "asc": 1, "desc": -1, "none": 0, None: 1}
    for s in _list(sort):
        if isinstance(s, dict) and "field" not in s and "value" not in s:
            s = {"field": next(iter(s)), "sort": next(iter(s.values()))}
        pair = (s.get("field", s.get("value")), ways[s.get("sort", 1)]) if isinstance(s, dict) else (s, 1)
        if pair[1]:
            out.append(pair)
    return out


def parse_edge(e: Any) -> Edge:
    if isinstance(e, str):
        return Edge(_leaf(e), e)
    value = e.get("value", e.get("name") if "range" not in e else None)
    name = e.get("name") or (_leaf(value) if isinstance(value, str) else None)
    if not name:
        raise ValueError(f"an edge needs a name: {e}")
    return Edge(name, value, Domain.of(e.get("domain")), e.get("allowNulls", True), e.get("range"))


def parse_window(w: dict) -> Window:
    agg, middle = w.get("aggregate"), None
    if isinstance(agg, dict):
        agg, middle = "stats", agg.get("middle")
    r = w.get("range")
    bounds = (r.get("min", r.get("start")), r.get("max", r.get("stop"))) if r else None
    return Window(w["name"], w.get("value"), _list(w.get("edges")), parse_sort(w.get("sort")), agg.lower() if agg else None, middle, bounds, w.get("where"))


def parse(q: dict | Query) -> Query:
    if isinstance(q, Query):
        return q
    unknown = set(q) - {"from", "select", "edges", "groupby", "where", "window", "sort", "limit", "name", "isLean", "format"}
    if unknown:
        raise ValueError(f"unknown clauses {sorted(unknown)}")
    select = q.get("select")
    return Query(
        q["from"], [parse_select(s) for s in _list(select)], [parse_edge(e) for e in _list(q.get("edges", q.get("groupby")))],
        filters.simplify(q.get("where")), [parse_window(w) for w in _list(q.get("window"))], parse_sort(q.get("sort")), q.get("limit"), not isinstance(select, list) and select is not None,
    )


class Engine:
    """Runs queries over named DataFrames (else catalog tables), with optional business dimensions."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None, dimensions: dict | Dimension | None = None) -> None:
        self.spark, self.tables = spark, dict(tables or {})
        self.root = Dimension.parse(dimensions) if isinstance(dimensions, dict) else dimensions

    def source(self, s: Any) -> DataFrame:
        if isinstance(s, DataFrame):
            return s
        if isinstance(s, Cube):
            return s.df
        if isinstance(s, (dict, Query)):
            return self.run(s)
        if isinstance(s, list):
            return self.spark.createDataFrame(s)
        return self.tables[s] if s in self.tables else self.spark.table(s)

    # Values -------------------------------------------------------------------------------------------------------
    def value(self, v: Any, flat: Flat) -> Column:
        """A path, a dimension's name, {"script": …}, a record or list of values, a constant {"literal": …}, a callable."""
        if isinstance(v, Column):
            return v
        if callable(v):
            return v(flat.col)
        if isinstance(v, str):
            if v == ".":
                return F.struct(*[F.col(f"`{c}`") for c in flat.schema.names])
            if self.root is not None and (dim := self.root.find(v)) is not None:
                return dim.column(flat.col)
            return flat.col(v)
        if isinstance(v, dict):
            if set(v) == {"script"}:
                return filters.script(v["script"])
            if set(v) == {"literal"}:
                return F.lit(v["literal"])
            return F.struct(*[self.value(x, flat).alias(n) for n, x in v.items()])
        if isinstance(v, (list, tuple)):
            return F.struct(*[self.value(x, flat).alias(f"_{i}") for i, x in enumerate(v)])
        return F.lit(v)

    def _paths(self, v: Any) -> list[str]:
        if isinstance(v, str):
            if v in (".", "*"):
                return []
            if self.root is not None and (dim := self.root.find(v)) is not None:
                return list(dim.paths().values())
            return [v]
        if isinstance(v, dict) and not set(v) & {"script", "literal"}:
            return [p for x in v.values() for p in self._paths(x)]
        return [p for x in v for p in self._paths(x)] if isinstance(v, (list, tuple)) else []

    # Clauses ------------------------------------------------------------------------------------------------------
    def run(self, q: dict | Query) -> DataFrame:
        q = parse(q)
        df = self.source(q.source)
        for w in q.window:
            flat = Flat(df, [])
            df = windows.apply_window(
                df, w.name, w.value if callable(w.value) and not isinstance(w.value, Column) else self.value(w.value, flat) if w.value is not None else None,
                [self.value(e, flat) for e in w.edges], self._sort(w.sort, flat), w.aggregate, w.bounds,
                filters.compile_filter(expand(w.where, self.root), flat.col) if w.where is not None else None, w.middle, flat.col,
            )
        where = expand(q.where, self.root)
        named = [p for s in q.select for p in self._paths(s.value)] + [p for e in q.edges for p in self._paths(e.value)]
        deep = [p for p in [*named, *filters.fields(where)] if arrays_on(df.schema, p, last=False)]
        # One path by itself: an empty list has no value to give; records keep their parents.
        keep = not (q.single and len(q.select) == 1 and not q.edges)
        conjuncts = where["and"] if isinstance(where, dict) and "and" in where else [where]
        on_row = [c for c in conjuncts if not any(arrays_on(df.schema, p, last=False) for p in filters.fields(c))]
        df = df.filter(filters.compile_filter({"and": on_row} if on_row else True, Flat(df, []).col, bare=True))
        flat = Flat(df, deep, keep)
        rest = [c for c in conjuncts if c not in on_row]
        flat.df = flat.df.filter(filters.compile_filter({"and": rest} if rest else True, flat.col, bare=True))
        if q.edges or any(s.aggregate != "none" for s in q.select):
            out = self._grouped(q, flat)
            return out.limit(q.limit) if q.limit is not None else out
        rows = flat.df.orderBy(*self._sort(q.sort, flat)) if q.sort else flat.df
        if q.select and not any(s.value == "*" for s in q.select):
            rows = rows.select(*[self.value(s.value, flat).alias(s.name if s.name != "." else "value") for s in q.select])
        else:
            rows = rows.select(*[c for c in rows.columns if c not in flat.alias.values()])
        return rows.limit(q.limit) if q.limit is not None else rows

    def _sort(self, sort: list[tuple[Any, int]], flat: Flat) -> list[Column]:
        return [self.value(f, flat).asc_nulls_first() if way > 0 else self.value(f, flat).desc_nulls_last() for f, way in sort]

    def _grouped(self, q: Query, flat: Flat) -> DataFrame:
        rows, keys = flat.df, []
        for e in q.edges:
            rows = self._edge(rows, e, flat)
            keys.append(e.name)
        for e in q.edges:
            if not e.nulls:
                rows = rows.filter(F.col(f"`{e.name}`").isNotNull())
        picks = q.select or [Select("count", None, "count")]
        aggs = []
        for s in picks:
            if s.aggregate == "none":
                raise ValueError(f"select {s.name} needs an aggregate")
            value = None if s.value in (None, ".") or s.value == s.name == s.aggregate else self.value(s.value, flat)
            c = aggregate(s.aggregate, value)
            aggs.append((F.coalesce(c, F.lit(s.default)) if s.default is not None else c).alias(s.name))
        out = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs) if keys else rows.agg(*aggs)
        if q.sort:
            names = {*keys, *(s.name for s in picks)}
            order = [(F.col(f"`{f}`") if f in names else F.col(f)) for f, _ in q.sort]
            out = out.orderBy(*[c.asc_nulls_first() if way > 0 else c.desc_nulls_last() for c, (_, way) in zip(order, q.sort, strict=True)])
        return out

    def _edge(self, rows: DataFrame, e: Edge, flat: Flat) -> DataFrame:
        d = e.domain
        if self.root is not None and isinstance(e.value, str) and (dim := self.root.find(e.value)) is not None and d.type == "default":
            d = dim.domain()
        if e.range:
            return range_edge(rows, e.name, flat.col(e.range["min"]), flat.col(e.range["max"]), d, e.range.get("mode", e.range.get("type", "snapshot")))
        value = self.value(e.value, flat) if e.value is not None else None
        part = d.part(value, flat.col)
        return rows.withColumn(e.name, F.explode_outer(part) if d.overlaps else part)

    def cube(self, q: dict | Query) -> Cube:
        """The query's result as a cube over its edges."""
        q = parse(q)
        domains = {e.name: (self.root.find(e.value).domain() if self.root is not None and isinstance(e.value, str) and self.root.find(e.value) else e.domain) for e in q.edges}
        picks = [s.name for s in q.select] or ["count"]
        return Cube(self.run(q), {e.name: domains[e.name].frame(self.spark, e.name, e.nulls) for e in q.edges}, picks, {e.name: e.nulls for e in q.edges})


def range_edge(rows: DataFrame, name: str, low: Column, high: Column, d: Domain, mode: str = "snapshot") -> DataFrame:
    """One row for each partition that a record's interval meets; partitions are regular, so no join is needed.

    ``snapshot``: the partition's start lies in [low, high]; ``inclusive``: the interval overlaps the partition. A missing
    ``high`` is open. Records that meet no partition keep one row with a missing part.
    """
    if not d.regular or d.min is None or d.max is None:
        raise ValueError(f"range edge {name}: a domain with min, max and interval is needed")
    lo, hi, step = d._bound(d.min), d._bound(d.max), d.step()
    a, b = d.number(low), F.coalesce(d.number(high), F.lit(float("inf")))
    last = -(-(hi - lo) // step) - 1
    if mode == "snapshot":
        first, final = F.ceil((a - lo) / step), F.least(F.floor((b - lo) / step), F.lit(last))
    else:
        first, final = F.floor((a - lo) / step), F.least(F.ceil((b - lo) / step) - 1, F.lit(last))
    first = F.greatest(first, F.lit(0)).cast("long")
    final = F.when(b == float("inf"), F.lit(last)).otherwise(final).cast("long")
    span = F.when(a.isNotNull() & (first <= final), F.sequence(first, F.greatest(first, final)))
    start = lambda i: F.lit(lo) + i * F.lit(step)
    out = rows.withColumn("__part", F.explode_outer(span))
    part = start(F.col("__part"))
    return out.withColumn(name, F.timestamp_millis(part.cast("long")) if d.type == "time" else part).drop("__part")


def tuples(df: DataFrame, names: list[str]) -> DataFrame:
    """One struct per row."""
    return df.select(F.struct(*[reduce(lambda c, n: c[n], split_path(p)[1:], F.col(split_path(p)[0])).alias(f"_{i}") for i, p in enumerate(names)]).alias("tuple"))

