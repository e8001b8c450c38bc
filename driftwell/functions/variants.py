"""JSON that is parsed once: text becomes a variant, and paths, items and types are read from that, without Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The variant of a JSON text; null where the text is none."""
    return F.try_parse_json(text)


def at(v: Column, path: str, kind: str = "string") -> Column:
    """The value under ``a.b[0].c`` in the wanted type; null where there is none or it does not convert."""
    return F.try_variant_get(v, f"$.{path}" if path and not path.startswith("[") else f"${path}", kind)


def items(df: DataFrame, v: str, name: str = "item", outer: bool = False) -> DataFrame:
    """A row for each element of the arrays (or entry of the objects) in column ``v``: ``name`` is a struct pos, key, value.

    The lateral join reads the parsed value; nothing is parsed again. ``outer`` keeps rows without elements.
    """
    table = df.sparkSession.tvf
    make = table.variant_explode_outer if outer else table.variant_explode
    each = make(F.col(v).outer()).select(F.struct("pos", "key", "value").alias(name))
    return df.lateralJoin(each)


def typed(v: Column) -> Column:
    """The schema of the value as text, such as ``BIGINT`` or ``OBJECT<k: BIGINT>``."""
    return F.schema_of_variant(v)
