"""String functions as Column expressions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\x00-\x20]+"


def between(v: Column, begin: str, end: str, start: int = 0) -> Column:
    """Text from the first ``begin`` at or after ``start`` to the first ``end`` behind it; null when either is absent."""
    at = F.locate(begin, v, start + 1)
    rest = F.substr(v, at + F.lit(len(begin)))
    stop = F.instr(rest, end)
    return F.when((at > 0) & (stop > 0), F.substr(rest, F.lit(1), stop - 1))


def between_last(v: Column, prefix: str, suffix: str) -> Column:
    """Text before the first ``suffix`` behind the first ``prefix``, from the right-most prefix in front of that suffix."""
    at = F.instr(v, prefix)
    stop = F.instr(F.substr(v, at + F.lit(len(prefix))), suffix)
    head = F.substr(v, F.lit(1), at + F.lit(len(prefix)) + stop - F.lit(2))
    return F.when((at > 0) & (stop > 0), F.substring_index(head, prefix, -1))


def left_but(v: Column, n: int) -> Column:
    """All but the last n characters."""
    return F.substr(v, F.lit(1), F.greatest(F.length(v) - n, F.lit(0)))


def right_but(v: Column, n: int) -> Column:
    """All but the first n characters."""
    return F.substr(v, F.lit(n + 1))


def find_first(v: Column, needles: list[str], start: int = 0) -> Column:
    """The smallest 0-based position of any needle at or after ``start``; -1 when none occurs."""
    found = [F.nullif(F.locate(n, v, start + 1), F.lit(0)) for n in needles]
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.coalesce(first - 1, F.lit(-1))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over the longer length; 1 where either is empty."""
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(1.0)).otherwise(F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def indent(v: Column, prefix: str = "\t", by: int = 1) -> Column:
    """A prefix before each line that is not empty; trailing white space stays as it is."""
    return F.regexp_replace(v, r"(?m)^(?=.)", prefix * by)


def outdent(v: Column) -> Column:
    """Every line without the white space that all non-blank lines begin with."""
    lines = F.split(v, "\n")
    depth = lambda x: F.length(x) - F.length(F.regexp_replace(x, r"^[ \t]+", ""))
    inked = F.filter(lines, lambda x: F.trim(x) != "")
    least = F.coalesce(F.array_min(F.transform(inked, depth)), F.lit(0))
    return F.array_join(F.transform(lines, lambda x: F.substr(x, least + 1)), "\n")


def deformat(v: Column) -> Column:
    return F.regexp_replace(v, "[^A-Za-z0-9]", "")


def remove_control(v: Column) -> Column:
    return F.regexp_replace(v, r"[\x00-\x1f]", " ")


def get_word(v: Column, delimiter: str, n: int) -> Column:
    """The n-th word from 0; '' past the end."""
    return F.split_part(v, F.lit(delimiter), F.lit(n + 1))


def word_count(v: Column, delimiter: str) -> Column:
    return F.size(F.split(v, r"\Q" + delimiter + r"\E"))


def locate_or_end(needle: str, v: Column, start: int = 1) -> Column:
    """1-based position, the length plus 1 where it is absent."""
    at = F.locate(needle, v, start)
    return F.when(at == 0, F.length(v) + 1).otherwise(at)


def is_numeric(v: Column) -> Column:
    return F.coalesce(v.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?([eE][+-]?[0-9]+)?$|^[+-]?\.[0-9]+([eE][+-]?[0-9]+)?$"), F.lit(False))


def is_digits(v: Column) -> Column:
    return F.coalesce(v.rlike("^[0-9]+$"), F.lit(False))


def trim_all(v: Column, side: str = "both") -> Column:
    """Without characters up to the blank at the ends; ``side``: both, left or right."""
    if side in ("both", "left"):
        v = F.regexp_replace(v, f"^{SPACES}", "")
    return F.regexp_replace(v, f"{SPACES}$", "") if side in ("both", "right") else v


def piped(values: Column) -> Column:
    """``|a|b|c|`` from an array; each value is framed."""
    return F.array_join(F.transform(values, lambda x: F.concat(F.lit("|"), x.cast("string"), F.lit("|"))), "")


def flag(name: str, v: Column) -> Column:
    return F.concat(F.lit(f" {name}"), v.cast("string"))


def quote(v: Column) -> Column:
    """A JSON string literal; null is written null."""
    one = F.substring(F.to_json(F.struct(v.alias("v"))), 6, 1 << 30)
    return F.when(v.isNull(), F.lit("null")).otherwise(left_but(one, 1))


def unquote(v: Column) -> Column:
    return F.get_json_object(F.concat(F.lit('{"v":'), v, F.lit("}")), "$.v")


def sql_literal(v: Column, kind: str) -> Column:
    """Text for SQL or CSV: numbers bare, strings in quotes with quotes doubled, missing values NULL."""
    if kind == "number":
        return F.coalesce(v.cast("string"), F.lit("NULL"))
    if kind == "timestamp":
        v = F.date_format(v, "yyyy-MM-dd HH:mm:ss")
    return F.when(v.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")))


def csv_to_tab(v: Column, columns: int) -> Column:
    """A CSV line with tabs between its values."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    row = F.from_csv(v, schema)
    return F.concat_ws("\t", *[F.coalesce(row[f"c{i}"], F.lit("")) for i in range(columns)])


def to_string(v: Column, kind: str = "value") -> Column:
    """'' for missing, JSON for containers, the text otherwise."""
    return F.coalesce(F.to_json(v) if kind == "container" else v.cast("string"), F.lit(""))


def patch(lines: Column, diff: Column, reverse: bool = False) -> Column:
    """A unified diff applied to an array of lines (backwards with ``reverse``)."""
    @F.pandas_udf("array<string>")
    def run(a: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else patched(list(x), [] if y is None else list(y), reverse) for x, y in zip(a, d, strict=True)])

    return run(lines, diff)


def patched(lines: list[str], diff: list[str], reverse: bool = False) -> list[str]:
    out, at = [], 0
    for line in diff:
        if m := re.match(r"@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@", line):
            first, count = int(m[3 if reverse else 1]), int(m[4 if reverse else 2] or 1)
            start = first - 1 if count else first
            out += lines[at:start]
            at = start
        elif line.startswith(("---", "+++")) and not out and not at:
            continue
        else:
            kind, body = line[:1] or " ", line[1:]
            if reverse:
                kind = {"+": "-", "-": "+"}.get(kind, kind)
            if kind == "+":
                out.append(body)
            elif kind in " -":
                if at >= len(lines) or lines[at] != body:
                    raise ValueError(f"the text does not match the diff at line {at + 1}")
                out += [body] if kind == " " else []
                at += 1
    return out + lines[at:]
