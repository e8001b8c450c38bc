"""Text templates with ``{{path|filter(args)}}``, expanded on the driver; filters are looked up, never evaluated.

A template is a text, a list of templates, or a record ``{"from": path, "template": …, "separator": …}`` that is expanded
for each item. Leading dots of a path climb to the enclosing items.
"""

from __future__ import annotations

import ast
import datetime as dt
import json
import math
import re
from typing import Any

_SLOT = re.compile(r"\{\{([^}]*)\}\}")
_FILTER = re.compile(r"^\s*(\w+)\s*(?:\((.*)\))?\s*$", re.DOTALL)


def _time(v: Any) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    return dt.datetime.fromtimestamp(v if v < 1e10 else v / 1000, dt.UTC).replace(tzinfo=None)


def _text(v: Any) -> str:
    if v is None:
        return ""
    if isinstance(v, (dict, list)):
        return json.dumps(v, sort_keys=True, default=str)
    if isinstance(v, dt.timedelta):
        return f"{v.total_seconds():g} seconds"
    return f"{v:g}" if isinstance(v, float) and v == int(v) and abs(v) < 1e15 else str(v)


def _round(v: float, decimal: int | None = None, digits: int | None = None) -> str:
    if digits is not None and v:
        m = 10 ** (math.ceil(math.log10(abs(v))) - digits)
        return _text(round(v / m) * m if m >= 1 else round(round(v / m) * m, 12))
    return _text(round(v, decimal or 0))


def _between(v: str, begin: str, end: str) -> str:
    stop = v.find(end, v.find(begin) + len(begin))
    return v[v.rfind(begin, 0, stop) + len(begin) : stop] if begin in v and stop >= 0 else ""


FILTERS = {
    "datetime": lambda v: _time(v).strftime("%Y-%m-%d %H:%M:%S"),
    "unix": lambda v: str(int(_time(v).replace(tzinfo=dt.UTC).timestamp())),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "newline": lambda v: "\n" + _text(v).lstrip("\n"),
    "replace": lambda v, a, b: _text(v).replace(a, b),
    "json": lambda v: json.dumps(v, sort_keys=True, default=str),
    "indent": lambda v, prefix="\t": "\n".join(prefix + x if x else x for x in _text(v).split("\n")),
    "outdent": lambda v: "\n".join(x[min((len(y) - len(y.lstrip()) for y in _text(v).split("\n") if y.strip()), default=0) :] for x in _text(v).split("\n")),
    "round": _round,
    "percent": lambda v, decimal=0: f"{v * 100:.{decimal}f}%",
    "between": lambda v, a, b: _between(_text(v), a, b),
    "left": lambda v, n: _text(v)[: max(n, 0)],
    "right": lambda v, n: _text(v)[-n:] if n > 0 else "",
}


def _get(stack: list, path: str) -> Any:
    up = len(path) - len(path.lstrip("."))
    here = stack[max(0, len(stack) - max(up, 1))]
    for name in [n for n in path.lstrip(".").split(".") if n]:
        here = here.get(name) if isinstance(here, dict) else getattr(here, name, None)
        if here is None:
            return None
    return here


def _slot(text: str, stack: list) -> str:
    path, *steps = re.split(r"\|(?=(?:[^\"']|\"[^\"]*\"|'[^']*')*$)", text)
    v = _get(stack, path.strip())
    for step in steps:
        m = _FILTER.match(step)
        if not m or m[1] not in FILTERS:
            raise ValueError(f"unknown filter {step}")
        call = ast.parse(f"f({m[2] or ''})", mode="eval").body
        args = [ast.literal_eval(a) for a in call.args]
        v = FILTERS[m[1]](v, *args, **{k.arg: ast.literal_eval(k.value) for k in call.keywords})
    return _text(v)


def expand(template: Any, context: Any, stack: list | None = None) -> str:
    stack = [*(stack or []), context]
    if isinstance(template, str):
        return _SLOT.sub(lambda m: _slot(m[1], stack), template)
    if isinstance(template, list):
        return "".join(expand(t, context, stack[:-1]) for t in template)
    items = _get(stack, template["from"]) or []
    return template.get("separator", "").join(expand(template["template"], x, stack) for x in items)
