"""The filter language, simplified and compiled to two-valued Column predicates.

A filter is a JSON object with one key: and, or, not, term, terms, range, missing, exists, prefix, instr, script, nested
or match_all. Predicates never yield null: a comparison with a missing value is false, and its negation is true.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Resolve = Callable[[str], Column]

#: The spellings of the four comparisons.
COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "gt": lambda c, v: c > v, ">": lambda c, v: c > v,
    "gte": lambda c, v: c >= v, ">=": lambda c, v: c >= v,
    "lt": lambda c, v: c < v, "<": lambda c, v: c < v,
    "lte": lambda c, v: c <= v, "<=": lambda c, v: c <= v,
}

#: Functions that a script may call; anything else is refused.
SCRIPT_FUNCTIONS = frozenset(
    "abs acos asin atan ceil ceiling coalesce concat contains cos date_trunc exp floor greatest if ifnull instr isnan isnotnull isnull least "
    "left length ln locate log log10 lower ltrim mod nullif pmod pow power regexp_extract replace right round rtrim sign sin sqrt split_part "
    "startswith endswith substring tan trim unix_millis unix_seconds upper".split()
)
_CALL = re.compile(r"([A-Za-z_]\w*)\s*\(")
_KEYWORDS = frozenset("and or not in like between case when then else end is null cast as".split())
_STRINGS = re.compile(r"'(?:[^'\\]|\\.)*'")


_PATH = re.compile(r"(?<![\w.`])([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*)(?!\w|\s*\()")


def script_paths(text: str) -> set[str]:
    """The names and dotted paths in an expression that are no keywords."""
    return {p for p in _PATH.findall(_STRINGS.sub("''", text)) if p.lower() not in _KEYWORDS | {"true", "false"}}


def script(text: str, resolve: Resolve | None = None) -> Column:
    """An expression that calls only the functions of ``SCRIPT_FUNCTIONS``. Paths through flattened arrays are read from their
    rows where ``resolve`` is the ``col`` of such a frame."""
    bare = _STRINGS.sub("''", text)
    if ";" in bare or "--" in bare or re.search(r"\b(select|from)\b", bare, re.IGNORECASE):
        raise ValueError(f"not an expression: {text}")
    for name in _CALL.findall(bare):
        if name.lower() not in SCRIPT_FUNCTIONS | _KEYWORDS:
            raise ValueError(f"function {name} is not allowed in a script")
    written = getattr(getattr(resolve, "__self__", None), "written", None)
    if written is None:
        return F.expr(text)
    # Quoted strings stay as they are; between them paths are replaced.
    pieces, at = [], 0
    swap = lambda s: _PATH.sub(lambda m: m[1] if m[1].lower() in _KEYWORDS else written(m[1]), s)
    for m in _STRINGS.finditer(text):
        pieces += [swap(text[at : m.start()]), m[0]]
        at = m.end()
    return F.expr("".join([*pieces, swap(text[at:])]))


def simplify(f: Any) -> Any:
    """Flatten and/or, fold constants, drop duplicates; the result is a filter, or True or False."""
    if f is None or f is True or f == {} or f == {"match_all": {}}:
        return True
    if f is False:
        return False
    ((op, arg),) = f.items()
    if op in ("and", "or"):
        neutral, parts = op == "and", []
        for x in map(simplify, arg):
            if x is neutral:
                continue
            if x is (not neutral):
                return not neutral
            for y in x[op] if isinstance(x, dict) and op in x else [x]:
                if y not in parts:
                    parts.append(y)
        return neutral if not parts else parts[0] if len(parts) == 1 else {op: parts}
    if op == "not":
        x = simplify(arg)
        if isinstance(x, bool):
            return not x
        return x["not"] if "not" in x else {"not": x}
    if op == "terms":
        if any(len(v) == 0 for v in arg.values()):
            return False
        return {"term": {k: v[0] for k, v in arg.items()}} if all(len(v) == 1 for v in arg.values()) else f
    if op in ("term", "range", "prefix", "instr") and not arg:
        return True
    return f


def fields(f: Any) -> set[str]:
    """The paths that a filter reads."""
    f = simplify(f)
    if isinstance(f, bool):
        return set()
    ((op, arg),) = f.items()
    if op in ("and", "or"):
        return set().union(*map(fields, arg))
    if op == "not":
        return fields(arg)
    if op in ("missing", "exists"):
        return {_field(arg)}
    if op == "nested":
        return {f"{arg['path']}"}
    return script_paths(arg["script"] if isinstance(arg, dict) else arg) if op == "script" else set(arg)


def _field(arg: Any) -> str:
    return arg["field"] if isinstance(arg, dict) else arg


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts) if parts else F.lit(False)


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _members(c: Column, values: list) -> Column:
    some = [v for v in values if v is not None]
    parts = ([c.isin(*some)] if some else []) + ([c.isNull()] if len(some) < len(values) else [])
    return _any(parts)


def _range(c: Column, bounds: dict) -> Column:
    parts = []
    for key, v in bounds.items():
        if key in COMPARE:
            parts.append(COMPARE[key](c, F.lit(v)))
        elif key == "from":
            parts.append(c >= v if bounds.get("include_lower", True) else c > v)
        elif key == "to":
            parts.append(c <= v if bounds.get("include_upper", True) else c < v)
        elif key not in ("include_lower", "include_upper"):
            raise ValueError(f"unknown bound {key}")
    return _all(parts)


#: The opposite of each comparison.
OPPOSITE = {"gt": "lte", ">": "<=", "gte": "lt", ">=": "<", "lt": "gte", "<": ">=", "lte": "gt", "<=": ">"}


def _opposite(f: Any, resolve: Resolve) -> Column:
    """Rows for which a filter does not hold, as comparisons that a reader takes."""
    if isinstance(f, bool):
        return F.lit(not f)
    ((op, arg),) = f.items()
    if op in ("and", "or"):
        return (_any if op == "and" else _all)([_opposite(x, resolve) for x in arg])
    if op == "not":
        return compile_filter(arg, resolve, bare=True)
    if op in ("missing", "exists"):
        return compile_filter({"exists" if op == "missing" else "missing": arg}, resolve)
    if op in ("term", "terms"):
        parts = []
        for k, v in arg.items():
            c, values = resolve(k), v if isinstance(v, list) else [v]
            some = [x for x in values if x is not None]
            other = ~c.isin(*some) if some else F.lit(True)
            parts.append((other & c.isNotNull()) if len(some) < len(values) else (other | c.isNull()))
        return _any(parts)
    if op == "range" and all(set(v) <= set(OPPOSITE) for v in arg.values()):
        return _any([_any([resolve(k).isNull(), *[COMPARE[OPPOSITE[o]](resolve(k), F.lit(x)) for o, x in v.items()]]) for k, v in arg.items()])
    return ~compile_filter(f, resolve)


def compile_filter(f: Any, resolve: Resolve = F.col, bare: bool = False) -> Column:
    """The predicate of a filter; ``resolve`` turns a path into a Column.

    ``bare``: the predicate only selects rows, where null is as good as false. Then comparisons and scripts stay as they are, and
    negations are pushed inwards to "missing or the opposite", so that the reader can take them.
    """
    f = simplify(f)
    if isinstance(f, bool):
        return F.lit(f)
    if len(f) != 1:
        raise ValueError(f"a filter has one key: {f}")
    ((op, arg),) = f.items()
    sub = lambda x: compile_filter(x, resolve, bare)
    sure = (lambda c: c) if bare else _sure
    if op == "and":
        return _all([sub(x) for x in arg])
    if op == "or":
        return _any([sub(x) for x in arg])
    if op == "not":
        return _opposite(simplify(arg), resolve) if bare else ~compile_filter(arg, resolve)
    if op == "term":
        return _all([sure(_members(resolve(k), v)) if isinstance(v, list) else resolve(k).eqNullSafe(F.lit(v)) for k, v in arg.items()])
    if op == "terms":
        return _all([sure(_members(resolve(k), v)) for k, v in arg.items()])
    if op == "range":
        return _all([sure(_range(resolve(k), v)) for k, v in arg.items()])
    if op == "missing":
        return resolve(_field(arg)).isNull()
    if op == "exists":
        return resolve(_field(arg)).isNotNull()
    if op == "prefix":
        return _all([sure(F.startswith(resolve(k), F.lit(v))) for k, v in arg.items()])
    if op == "instr":
        return _all([sure(F.contains(resolve(k), F.lit(v))) for k, v in arg.items()])
    if op == "script":
        return sure(script(arg["script"] if isinstance(arg, dict) else arg, resolve))
    if op == "nested":
        path = arg["path"]
        inner = lambda row: lambda p: reduce(lambda c, n: c[n], p.removeprefix(f"{path}.").split("."), row)
        return _sure(F.exists(resolve(path), lambda row: compile_filter(arg["query"], inner(row))))
    raise ValueError(f"unknown filter {op}")
