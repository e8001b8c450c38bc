"""Business dimensions: logical names for fields, hierarchical, with members listed from the data."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import filters
from .domains import Domain


@dataclass
class Dimension:
    """``field``: a path, a list of paths or a record of paths; ``edges``: sub-dimensions; ``partitions``: named filters."""

    name: str
    field: Any = None
    type: str = "set"
    limit: int | None = None
    where: Any = None
    partitions: list = dataclasses.field(default_factory=list)
    edges: dict[str, Dimension] = dataclasses.field(default_factory=dict)
    facet: bool = False

    @classmethod
    def parse(cls, d: dict, name: str = ".") -> Dimension:
        kids = d.get("edges", [])
        out = cls(d.get("name", name), d.get("field"), d.get("type", "set"), d.get("limit"), d.get("esfilter"), list(d.get("partitions", [])), facet=bool(d.get("isFacet")))
        out.edges = {k["name"]: cls.parse(k) for k in kids}
        return out

    def find(self, path: str) -> Dimension | None:
        here = self
        for n in path.split("."):
            if (here := here.edges.get(n)) is None:
                return None
        return here

    def paths(self) -> dict[str, str]:
        """name → path of each field of the key."""
        if self.field is None:
            return {}
        if isinstance(self.field, dict):
            return dict(self.field)
        names = self.field if isinstance(self.field, list) else [self.field]
        return {n.split(".")[-1]: n for n in names}

    def column(self, resolve: filters.Resolve = F.col) -> Column:
        """The value: a field, or a struct of the key's fields."""
        if not self.field:
            return F.lit(None)
        if isinstance(self.field, str):
            return resolve(self.field)
        return F.struct(*[resolve(p).alias(n) for n, p in self.paths().items()])

    def term(self, value: Any) -> dict:
        """The filter that says this dimension has that value; a missing value means missing fields."""
        for p in self.partitions:
            if isinstance(p, dict) and p.get("name") == value:
                return p.get("esfilter", {"term": {self.field: p.get("value", value)}})
        if isinstance(self.field, str):
            return {"missing": self.field} if value is None else {"term": {self.field: value}}
        if value is None:
            return {"and": [{"missing": p} for p in self.paths().values()]}
        pairs = value if isinstance(value, dict) else dict(zip(self.paths(), value, strict=True))
        return {"and": [{"missing": self.paths()[n]} if v is None else {"term": {self.paths()[n]: v}} for n, v in pairs.items()]}

    def domain(self) -> Domain:
        if self.partitions:
            return Domain("facet" if self.facet else "set", self.partitions)
        return Domain("uid" if self.type == "uid" else "default")

    def members(self, df: DataFrame, resolve: filters.Resolve = F.col) -> DataFrame:
        """Members with counts, most frequent first; for a list of fields with a subtotal row for each prefix."""
        rows = df.filter(filters.compile_filter(self.where, resolve))
        keys = [resolve(p).alias(n) for n, p in self.paths().items()]
        rows = rows.select(*keys)
        names = list(self.paths())
        if isinstance(self.field, list) and len(names) > 1:
            rows = rows.rollup(*names).agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("level"))
        else:
            rows = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("count"))
        rows = rows.orderBy(F.desc("count"), *[F.col(n).asc_nulls_first() for n in names])
        return rows.limit(self.limit) if self.limit else rows


def expand(where: Any, root: Dimension | None) -> Any:
    """The filter with dimension names replaced by their fields."""
    where = filters.simplify(where)
    if root is None or isinstance(where, bool):
        return where
    ((op, arg),) = where.items()
    if op in ("and", "or"):
        return filters.simplify({op: [expand(x, root) for x in arg]})
    if op == "not":
        return filters.simplify({"not": expand(arg, root)})
    if op in ("term", "terms"):
        parts = []
        for name, v in arg.items():
            if (dim := root.find(name)) is None:
                parts.append({op: {name: v}})
            elif op == "term":
                parts.append(dim.term(v))
            else:
                parts.append({"or": [dim.term(x) for x in v]})
        return filters.simplify({"and": parts})
    if op == "range":
        return {"range": {(d.field if (d := root.find(n)) is not None else n): b for n, b in arg.items()}}
    if op in ("missing", "exists"):
        name = arg["field"] if isinstance(arg, dict) else arg
        dim = root.find(name)
        if dim is None:
            return where
        gone = dim.term(None)
        return gone if op == "missing" else filters.simplify({"not": gone})
    return where
