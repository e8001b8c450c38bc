"""JSON text as Column expressions: values by tag, arrays, encoding, dotted keys."""

from __future__ import annotations

import json
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tagged(tag: str, body: str) -> str:
    return rf'"{re.escape(tag)}"\s*:\s*{body}'


def string(v: Column, tag: str) -> Column:
    """The first string under a tag, at any depth; null when there is none."""
    p = _tagged(tag, r'"((?:[^"\\]|\\.)*)"')
    return F.when(v.rlike(p), F.regexp_extract(v, p, 1))


def number(v: Column, tag: str) -> Column:
    p = _tagged(tag, r"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)")
    return F.when(v.rlike(p), F.regexp_extract(v, p, 1)).try_cast("double")


def array(v: Column, tag: str) -> Column:
    """The text of the first array of primitives under a tag."""
    p = _tagged(tag, r"(\[[^\[\]{}]*\])")
    return F.when(v.rlike(p), F.regexp_extract(v, p, 1))


def obj(v: Column, tag: str) -> Column:
    """The text of the first object under a tag at any depth; braces inside strings do not count."""
    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else first_object(t, tag))

    return run(v)


def first_object(text: str, tag: str) -> str | None:
    for m in re.finditer(_tagged(tag, r"(?=\{)"), text):
        depth, quoted, i = 0, False, m.end()
        while i < len(text):
            c = text[i]
            if quoted:
                i += c == "\\"
                quoted = c != '"'
            elif c == '"':
                quoted = True
            elif c in "{}":
                depth += 1 if c == "{" else -1
                if not depth:
                    return text[m.end() : i + 1]
            i += 1
    return None


def numbers(v: Column) -> Column:
    return F.from_json(v, "array<double>")


def item(values: Column, i: int) -> Column:
    """0-based; null beyond the ends."""
    return F.get(values, F.lit(i))


def part(values: Column, start: int, end: int) -> Column:
    """Half-open and clipped."""
    return F.slice(values, start + 1, max(0, end - start))


def array_stats(v: Column) -> Column:
    """``[n, mean, population variance]`` of a JSON array of numbers."""
    x = numbers(v)
    n = F.size(x).cast("double")
    mean = F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / n
    square = F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b) / n
    return F.when(n > 0, F.array(n, mean, F.greatest(square - mean * mean, F.lit(0.0))))


def encode(df: DataFrame, columns: list[str] | None = None) -> Column:
    """JSON with sorted keys, so that equal records have equal text."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns or df.columns)]), {"ignoreNullFields": "true"})


def expand_dot(record: Any) -> Any:
    """Dotted keys as nested records."""
    if isinstance(record, list):
        return [expand_dot(x) for x in record]
    if not isinstance(record, dict):
        return record
    out: dict = {}
    for k, v in record.items():
        at, names = out, [n.replace("\0", ".") for n in k.replace("\\.", "\0").split(".")]
        for n in names[:-1]:
            at = at.setdefault(n, {})
        v = expand_dot(v)
        at[names[-1]] = at[names[-1]] | v if isinstance(at.get(names[-1]), dict) and isinstance(v, dict) else v
    return out


_COMMENT = re.compile(r'("(?:[^"\\]|\\.)*")|//[^\n]*|#[^\n]*|/\*.*?\*/', re.DOTALL)
_COMMA = re.compile(r'("(?:[^"\\]|\\.)*")|,(?=\s*[\]}])', re.DOTALL)


def loads(text: str, params: dict | None = None, flexible: bool = False, paths: bool = False) -> Any:
    """Settings text: ``{{name}}`` parameters, comments and trailing commas (``flexible``), dotted keys (``paths``)."""
    if params:
        text = re.sub(r"\{\{\s*([\w.]+)\s*\}\}", lambda m: json.dumps(params[m[1]]), text)
    if flexible:
        for pattern in (_COMMENT, _COMMA):
            text = pattern.sub(lambda m: m[1] or "", text)
    out = json.loads(text)
    return expand_dot(out) if paths else out


def auto_expand(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns that begin with [ or { as variants; other text as a variant string."""
    for c in columns:
        parsed = F.when(F.ltrim(F.col(c)).rlike(r"^[\[{]"), F.try_parse_json(F.col(c)))
        df = df.withColumn(c, F.coalesce(parsed, F.to_variant_object(F.array(F.col(c))).cast("variant")))
    return df
