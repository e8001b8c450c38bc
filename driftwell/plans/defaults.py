"""Defaults for records, at any depth: a missing value takes its default, records are filled field by field."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _literal(v: Any) -> Column:
    if isinstance(v, dict):
        return F.struct(*[_literal(x).alias(k) for k, x in v.items()])
    return F.array(*map(_literal, v)) if isinstance(v, list) else F.lit(v)


def filled(c: Column, kind: T.DataType, default: Any) -> Column:
    """``c`` with its missing leaves replaced: ``default`` is a value, a record of defaults, or (column, type).

    A record takes each field's default, fields that only the default has are added at the end, and a missing record becomes
    its default. Everything that is no record is one value. One ``coalesce`` a leaf.
    """
    column, shape = default if isinstance(default, tuple) else (_literal(default) if default is not None else None, None)
    if isinstance(kind, T.StructType) and (isinstance(default, dict) or isinstance(shape, T.StructType)):
        names = list(default) if isinstance(default, dict) else shape.names
        sub = (lambda n: default[n]) if isinstance(default, dict) else (lambda n: (column[n], shape[n].dataType))
        own = [(filled(c[f.name], f.dataType, sub(f.name)) if f.name in names else c[f.name]).alias(f.name) for f in kind.fields]
        more = [(_literal(sub(n)) if isinstance(default, dict) else column[n]).alias(n) for n in names if n not in kind.names]
        return F.struct(*own, *more)
    return c if column is None else F.coalesce(c, column.cast(kind) if not isinstance(kind, (T.StructType, T.NullType)) else column)


def with_defaults(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """All columns with their defaults; columns that only the defaults have are added."""
    own = [(filled(F.col(f"`{f.name}`"), f.dataType, defaults[f.name]) if f.name in defaults else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema.fields]
    return df.select(*own, *[_literal(v).alias(k) for k, v in defaults.items() if k not in df.columns])


def with_defaults_of(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """The same with each row's defaults from the row of another table with its keys."""
    shape = T.StructType([f for f in other.schema.fields if f.name not in keys])
    joined = df.join(other.select(*keys, F.struct(*shape.names).alias("default_")), keys, "left")
    own = [f for f in df.schema.fields if f.name not in keys]
    fill = [(filled(F.col(f.name), f.dataType, (F.col("default_")[f.name], shape[f.name].dataType)) if f.name in shape.names else F.col(f.name)).alias(f.name) for f in own]
    return joined.select(*keys, *fill, *[F.col("default_")[n].alias(n) for n in shape.names if n not in df.columns])
