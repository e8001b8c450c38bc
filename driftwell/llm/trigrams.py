"""From a regular expression to a Boolean query over trigrams of the lower-cased text.

A query is None (every text may match) or a frozenset of alternatives, each a frozenset of trigrams that must all occur.
"""

from __future__ import annotations

import re._constants as K
import re._parser as parser

#: An exact set larger than this is cut into trigrams at once.
EXACT = 64


def _tri(strings: set[str]) -> frozenset | None:
    """Some of these strings occurs in the text."""
    found = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    if not found or not all(found):
        return None
    return frozenset(x for x in found if not any(y < x for y in found))


def _and(a: frozenset | None, b: frozenset | None) -> frozenset | None:
    if a is None or b is None:
        return b if a is None else a
    both = {x | y for x in a for y in b}
    return frozenset(x for x in both if not any(y < x for y in both))


def _node(op, arg) -> tuple[set[str] | None, frozenset | None]:
    """(all strings it can match, or None if they are too many; a query that any match satisfies)"""
    if op is K.LITERAL:
        return {chr(arg).lower()}, None
    if op is K.IN:
        chars = {chr(v).lower() for o, v in arg if o is K.LITERAL}
        return (chars, None) if len(chars) <= 8 and all(o is K.LITERAL for o, _ in arg) else (None, None)
    if op is K.SUBPATTERN:
        return _sequence(arg[-1])
    if op is K.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(e is not None for e, _ in parts) and len(out := set().union(*(e for e, _ in parts))) <= EXACT:
            return out, None
        queries = [_tri(e) if e is not None else q for e, q in parts]
        return None, None if None in queries else frozenset().union(*queries)
    if op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
        low, high, inner = arg
        exact, query = _sequence(inner)
        if exact is not None and (low, high) in ((0, 1), (1, 1)):
            return exact | ({""} if low == 0 else set()), None
        if low == 0:
            return None, None
        return None, _tri(exact) if exact is not None else query
    return None, None


def _sequence(items) -> tuple[set[str] | None, frozenset | None]:
    run, query, whole = {""}, None, True
    for op, arg in items:
        exact, own = _node(op, arg)
        if exact is not None and len(run) * len(exact) <= EXACT:
            run = {a + b for a in run for b in exact}
            continue
        query, whole = _and(query, _tri(run)), False
        run = exact if exact is not None else {""}
        query = _and(query, own)
    return (run, None) if whole else (None, _and(query, _tri(run)))


def derive(pattern: str) -> frozenset | None:
    """The trigram query of a pattern; None: no trigram is mandatory."""
    exact, query = _sequence(parser.parse(pattern))
    return _tri(exact) if exact is not None else query
