"""Dotted paths into nested records: which arrays lie on them, and rows flattened along one branch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_path(path: str) -> list[str]:
    r"""Names of a path; ``\.`` is a dot within a name, a trailing dot means the value itself."""
    parts = path.replace("\\.", "\0").split(".")
    return [p.replace("\0", ".") for p in parts if p]


def join_path(names: list[str]) -> str:
    return ".".join(n.replace(".", "\\.") for n in names)


def _child(kind: T.DataType, name: str) -> T.DataType | None:
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return next((f.dataType for f in kind.fields if f.name == name), None) if isinstance(kind, T.StructType) else None


def arrays_on(schema: T.StructType, path: str, last: bool = True) -> list[str]:
    """Prefixes of the path that are arrays of records, and the path itself if it is an array (with ``last``)."""
    out, kind, names = [], schema, split_path(path)
    for i, n in enumerate(names):
        kind = _child(kind, n)
        if kind is None:
            return out
        if isinstance(kind, T.ArrayType) and (last or i < len(names) - 1):
            out.append(join_path(names[: i + 1]))
    return out


def branch(schema: T.StructType, paths: list[str], last: bool = False) -> list[str]:
    """The arrays that must be flattened for all paths, outermost first; they must lie on one branch."""
    found = sorted({a for p in paths for a in arrays_on(schema, p, last)}, key=lambda a: len(split_path(a)))
    for outer, inner in zip(found, found[1:], strict=False):
        if split_path(inner)[: len(split_path(outer))] != split_path(outer):
            raise ValueError(f"only one branch can be flattened: {outer}, {inner}")
    return found


class Flat:
    """A frame whose arrays along one branch are flattened; ``col`` resolves paths of the original schema."""

    def __init__(self, df: DataFrame, paths: list[str], keep_empty: bool = True, last: bool = False) -> None:
        self.schema, self.alias = df.schema, {}
        explode = F.explode_outer if keep_empty else F.explode
        for array in branch(df.schema, paths, last):
            name = f"__{array}".replace(".", "__")
            if keep_empty:
                df = df.withColumn(name, explode(self.col(array)))
            else:
                # An empty list gives no row, a missing list one missing value.
                whole = self.col(array)
                df = df.withColumn(name, explode(F.when(whole.isNull(), F.array(F.lit(None).cast(self._element(df, whole)))).otherwise(whole)))
            self.alias[array] = name
        self.df = df

    @staticmethod
    def _element(df: DataFrame, c: Column) -> T.DataType:
        return df.select(c).schema[0].dataType.elementType

    def written(self, path: str) -> str:
        """The path as it is written in SQL: from the flattened row where it leads through one."""
        names = split_path(path)
        for n in range(len(names), 0, -1):
            if (head := join_path(names[:n])) in self.alias:
                return ".".join(f"`{x}`" for x in [self.alias[head], *names[n:]])
        return path

    def col(self, path: str) -> Column:
        names = split_path(path)
        for n in range(len(names), 0, -1):
            if (head := join_path(names[:n])) in self.alias:
                return reduce(lambda c, x: c[x], names[n:], F.col(f"`{self.alias[head]}`"))
        return reduce(lambda c, x: c[x], names[1:], F.col(f"`{names[0]}`"))


def leaves(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[str]:
    """Paths of all leaves, arrays of records entered."""
    out = []
    for f in schema.fields:
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        out += leaves(kind, (*prefix, f.name)) if isinstance(kind, T.StructType) else [join_path([*prefix, f.name])]
    return out


def drill_filter(df: DataFrame, where: dict, keep_empty: bool = True) -> Flat:
    """Rows that pass a filter on nested paths: parts that read a deeper level are applied to that level's rows.

    Conjuncts on the record itself are applied before flattening. A record with no children stays if it passes otherwise.
    """
    from . import filters

    where = filters.simplify(where)
    parts = where["and"] if isinstance(where, dict) and "and" in where else [where]
    nested = lambda p: any(arrays_on(df.schema, x, last=True) for x in filters.fields(p))
    early, late = [p for p in parts if not nested(p)], [p for p in parts if nested(p)]
    top = Flat(df, [])
    df = df.filter(filters.compile_filter({"and": early} if early else True, top.col))
    paths = [x for p in late for x in filters.fields(p)]
    flat = Flat(df, paths, keep_empty, last=True)
    flat.df = flat.df.filter(filters.compile_filter({"and": late} if late else True, flat.col))
    return flat
