"""Domains: the value space of an edge, as an expression from a value to a part, and as a frame of all parts."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.durations import millis_of
from . import filters


@dataclass
class Domain:
    """``type``: default, value, uid, set, facet, time, duration, numeric or count."""

    type: str = "default"
    partitions: list = field(default_factory=list)
    min: Any = None
    max: Any = None
    interval: Any = None
    key: str = "value"

    @classmethod
    def of(cls, d: Any) -> Domain:
        if d is None:
            return cls()
        if isinstance(d, Domain):
            return d
        if isinstance(d, str):
            return cls(type=d)
        kind = d.get("type", "set" if "partitions" in d else "default")
        if kind == "set" and d.get("isFacet"):
            kind = "facet"
        return cls(kind, list(d.get("partitions", [])), d.get("min"), d.get("max"), d.get("interval"), d.get("key", "value"))

    def _parts(self) -> list[dict]:
        out = []
        for p in self.partitions:
            p = p if isinstance(p, dict) else {"name": p, self.key: p}
            out.append({"name": p.get("name", p.get(self.key)), "value": p.get(self.key, p.get("name")), "where": p.get("esfilter", p.get("where"))})
        return out

    @property
    def overlaps(self) -> bool:
        return self.type == "facet"

    @property
    def regular(self) -> bool:
        return self.type in ("time", "duration", "numeric", "count") and self.interval not in (None, "none")

    def _bound(self, v: Any) -> float | None:
        return None if v is None else float(millis_of(v)) if self.type == "duration" else float(_epoch_millis(v)) if self.type == "time" else float(v)

    def step(self) -> float:
        return float(millis_of(self.interval)) if self.type in ("time", "duration") else float(self.interval)

    def number(self, value: Column, kind: str | None = None) -> Column:
        """The value as the number that buckets are cut from: milliseconds for times."""
        if self.type == "time" and kind != "number":
            return F.unix_millis(value.cast("timestamp")).cast("double")
        return value.cast("double")

    def part(self, value: Column | None, resolve: filters.Resolve = F.col, kind: str | None = None) -> Column:
        """The part that a value falls into: null where there is none; for facets an array of all that match."""
        if self.type in ("default", "value", "uid") or (self.interval == "none"):
            return value
        if self.type == "set":
            out = F.when(F.lit(False), F.lit(None))
            for p in self._parts():
                test = filters.compile_filter(p["where"], resolve) if p["where"] is not None else value.eqNullSafe(F.lit(p["value"]))
                out = out.when(test, F.lit(p["name"]))
            return out
        if self.type == "facet":
            return F.array_compact(F.array(*[F.when(filters.compile_filter(p["where"], resolve), F.lit(p["name"])) for p in self._parts()]))
        if self.type == "time" and self.interval == "month":
            start = F.date_trunc("month", value.cast("timestamp"))
            return self._inside(self.number(value, kind), start)
        x = self.number(value, kind)
        lo = self._bound(self.min)
        hi = self._bound(self.max)
        # Buckets are counted from the lower bound, else the upper, else zero (for times 2000-01-01).
        ref = lo if lo is not None else hi if hi is not None else (float(_epoch_millis("2000-01-01")) if self.type == "time" else 0.0)
        start = F.lit(ref) + F.floor((x - F.lit(ref)) / F.lit(self.step())) * F.lit(self.step())
        if self.type == "time":
            start = F.timestamp_millis(start.cast("long"))
        return self._inside(x, start)

    def _inside(self, x: Column, out: Column) -> Column:
        test = x.isNotNull()
        if self.min is not None:
            test &= x >= self._bound(self.min)
        if self.max is not None:
            test &= x < self._bound(self.max)
        return F.when(test, out)

    def frame(self, spark: SparkSession, name: str, nulls: bool = True) -> DataFrame | None:
        """All parts as (name, name + '_order'), with the missing part last; None where parts come from the data."""
        if self.type in ("set", "facet"):
            # Values of the plan, whose small size is known, so that a cube's grid is made by broadcasts.
            parts = [F.struct(F.lit(p["name"]).cast("string").alias(name), F.lit(i).alias(f"{name}_order")) for i, p in enumerate(self._parts())]
            rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*parts))) if parts else spark.createDataFrame([], f"`{name}` string, `{name}_order` int")
        elif self.regular and self.min is not None and self.max is not None and self.interval != "month":
            lo, hi, step = self._bound(self.min), self._bound(self.max), self.step()
            n = max(0, -(-int(hi - lo) // int(step)) if step == int(step) else int((hi - lo) / step + 0.999999))
            ids = spark.range(n)
            start = F.lit(lo) + F.col("id") * F.lit(step)
            rows = ids.select((F.timestamp_millis(start.cast("long")) if self.type == "time" else start).alias(name), F.col("id").cast("int").alias(f"{name}_order"))
        else:
            return None
        if nulls:
            last = spark.range(0, 1, 1, 1).select(F.lit(None).cast(rows.schema[0].dataType).alias(name), F.lit(2**31 - 1).alias(f"{name}_order"))
            rows = rows.unionByName(last)
        return rows


def _epoch_millis(v: Any) -> int:
    """Milliseconds of an ISO date, a datetime, or a number (seconds below 1e10)."""
    import datetime as dt

    if isinstance(v, (int, float)):
        return int(v * 1000 if v < 1e10 else v)
    if isinstance(v, str):
        v = dt.datetime.fromisoformat(v)
    if not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    return int((v if v.tzinfo else v.replace(tzinfo=dt.UTC)).timestamp() * 1000)
