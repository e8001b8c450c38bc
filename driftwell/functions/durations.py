"""Durations: sums of units, with months apart from milliseconds, and interval literals of the query language."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

#: Milliseconds of each unit. A year is 52 weeks, a quarter 13 weeks, a month 28 days.
SECOND, MINUTE, HOUR = 1000, 60_000, 3_600_000
DAY, WEEK = 86_400_000, 604_800_000
MILLIS = {"milli": 1, "second": SECOND, "minute": MINUTE, "hour": HOUR, "day": DAY, "week": WEEK, "month": 28 * DAY, "quarter": 13 * WEEK, "year": 52 * WEEK}
MONTHS = {"month": 1, "quarter": 3, "year": 12}
_TERM = re.compile(r"\s*([+-]?)\s*(\d+(?:\.\d+)?)?\s*([a-z]+?)s?\s*(?=[+-]|$)")
#: Interval sizes that charts choose from.
COMMON = tuple(n * MILLIS[u] for n, u in ((1, "second"), (5, "second"), (15, "second"), (30, "second"), (1, "minute"), (5, "minute"), (15, "minute"), (30, "minute"), (1, "hour"), (2, "hour"), (3, "hour"), (6, "hour"), (12, "hour"), (1, "day"), (1, "week"), (2, "week"), (1, "month"), (2, "month"), (1, "quarter"), (6, "month"), (1, "year")))


@dataclass(frozen=True)
class Duration:
    """``milli`` covers the months too, by their canonical length."""

    milli: float = 0
    month: float = 0

    @classmethod
    def parse(cls, text: str) -> Duration:
        out, at = cls(), 0
        while at < len(text):
            m = _TERM.match(text, at)
            if not m or m[3] not in MILLIS:
                raise ValueError(f"not a duration: {text}")
            n = float(m[2] or 1) * (-1 if m[1] == "-" else 1)
            out += cls(n * MILLIS[m[3]], n * MONTHS.get(m[3], 0))
            at = m.end()
        return out

    def __add__(self, other: Duration) -> Duration:
        return Duration(self.milli + other.milli, self.month + other.month)

    def __sub__(self, other: Duration) -> Duration:
        return Duration(self.milli - other.milli, self.month - other.month)

    def __mul__(self, n: float) -> Duration:
        return Duration(self.milli * n, self.month * n)

    def __truediv__(self, other: Any) -> Any:
        if isinstance(other, Duration):
            return self.month / other.month if other.month and self.month else self.milli / other.milli
        return Duration(self.milli / other, self.month / other)

    def floor(self, unit: Duration) -> Duration:
        if unit.month:
            n = self.month // unit.month
            return Duration(n * unit.milli, n * unit.month)
        return Duration(self.milli // unit.milli * unit.milli)

    def round(self, unit: Duration, digits: int = 0) -> float:
        return round(self / unit, digits)

    def __str__(self) -> str:
        if not self.milli:
            return "zero"
        parts, rest = [], abs(self.milli)
        if self.month:
            years, months = divmod(abs(self.month), 12)
            parts += [f"{int(n)}{u}" for n, u in ((years, "year"), (months, "month")) if n]
            rest -= abs(self.month) * MILLIS["month"] if not years else years * MILLIS["year"] + months * MILLIS["month"]
        for unit in ("week", "day", "hour", "minute", "second", "milli"):
            n, rest = divmod(rest, MILLIS[unit])
            if n:
                parts.append(f"{int(n)}{unit}")
        return ("-" if self.milli < 0 else "") + "+".join(parts)


def millis_of(v: Any) -> float:
    """Milliseconds of a duration, a text such as "2week+3day", or a number of milliseconds."""
    if isinstance(v, Duration):
        return v.milli
    return Duration.parse(v).milli if isinstance(v, str) else v


def nice_interval(span: float, most: int = 30) -> float:
    """The smallest common interval that cuts a span into at most so many parts."""
    return next((c for c in COMMON if span / c <= most), COMMON[-1])
