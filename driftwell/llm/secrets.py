"""Secret scans through a trigram inverted index, with Spark expressions only.

For each rule a Boolean query over trigrams is derived from its regular expression. The index holds one posting for each
document and each trigram that some query names (a fixed vocabulary, whatever the table's size). The postings of each
alternative of a query are intersected, and only the documents that remain are searched with the expression itself; a
trigram that most documents hold is no hot key, as the intersection is grouped by document. Rules without mandatory trigrams
scan all documents.

Matches are found leftmost and without overlaps per rule; a match whose group is too short is dropped after it was found,
as its text is then used up. Offsets are code points, ends exclusive.

Edge cases: a null text is empty; a null id is an ordinary value; repeated rows are reported once each; a very long text is
searched whole, in one task; an empty table gives no rows; other columns are ignored by ``report`` and kept by ``redact``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, text_or_empty
from .trigrams import derive


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group that must have ``least`` characters.
    group: int = 0
    least: int = 0


#: A PEM private key: the BEGIN line, then headers, base64 lines and the END line. Where a base64 body is cut off before its
#: END line: its lines of a width that PEM writers use, and a shorter last one of 16 characters at least. Groups repeat only
#: texts of one length, which Java's matcher does without recursion.
_BODY = "|".join(f"(?:{end}[A-Za-z0-9+/]{{{n}}})+(?:{end}[A-Za-z0-9+/]{{16,{n}}}={{0,2}})?" for n in (76, 70, 64) for end in (r"\r\n", r"\n", r"\\n"))
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:(?:[\\nr\x20\t\r\n]*Proc-Type:[^\n\\]*)?(?:[\\nr\x20\t\r\n]*DEK-Info:[^\n\\]*[\\nr\r\n]*)?"
    rf"(?:[A-Za-z0-9+/=\\\x20\t\r\n]*-----END [A-Z ]*PRIVATE KEY-----|{_BODY}))?"
)

#: The three kinds that every report counts, in report order, then the kinds that the index adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", PRIVATE_KEY),
)
BASE = ("assign", "access", "hex")


def _spans(rule: Rule, order: int, pieces: str, found: str, groups: str) -> Column:
    """Spans from the texts between the matches, the matches and the groups."""
    steps = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(found)), lambda i: i < F.size(found)),
        lambda i: F.struct(
            F.length(F.get(pieces, i)).alias("gap"), F.length(F.get(found, i)).alias("width"), F.length(F.get(groups, i)).alias("inner")
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + step["width"]
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        grown = F.when(step["inner"] >= rule.least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), grown.alias("out"))

    return F.aggregate(steps, empty, add, lambda s: s["out"])


def index(keyed: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, list[str]]:
    """Postings (gram, key, th) and the vocabulary; ``gram`` is a position in the vocabulary."""
    grams = sorted({g for r in rules for x in derive(r.pattern) or () for g in x})
    low = keyed.select("key", "th", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("key", "th", F.explode(held).alias("gram")), grams


def candidates(postings: DataFrame, grams: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, th, rules: for each document with any rule's trigrams, the positions of those rules.

    The postings of an alternative's trigrams are intersected by collecting one bit for each trigram.
    """
    place = {g: i for i, g in enumerate(grams)}
    rows = [
        (place[g], i, alt, 1 << bit, (1 << len(part)) - 1)
        for i, rule in enumerate(rules)
        for alt, part in enumerate(sorted(map(sorted, derive(rule.pattern) or ())))
        for bit, g in enumerate(part)
    ]
    values = ", ".join(f"({g}, {i}, {alt}, {bit}L, {every}L)" for g, i, alt, bit, every in rows)
    wanted = postings.sparkSession.sql(f"SELECT * FROM VALUES {values} AS wanted(gram, rule, alt, bit, every)")
    met = postings.join(F.broadcast(wanted), "gram").groupBy("key", "th", "rule", "alt", "every").agg(F.bit_or("bit").alias("bits")).filter("bits = every")
    return met.groupBy("key", "th").agg(F.collect_set("rule").alias("rules"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, spans: array of (start, kind, end) by start, then by the rules' order."""
    return scanned(docs, key, text, rules).select(F.col("key").alias(key), "spans")


def scanned(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, kept, spans; ``kept`` is a struct of the columns in ``keep``, whose names can clash with nothing there."""
    keyed = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"), F.xxhash64(text_or_empty(text)).alias("th"), F.struct(F.lit(0), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]).alias("kept"))
    # Written, so that the join is planned by the candidates' true size: few are broadcast, and no text is shuffled.
    stash = Stash(docs.sparkSession, "secrets")
    postings, grams = index(keyed, rules)
    found = stash.keep(candidates(stash.keep(postings, "postings"), grams, rules), "candidates").alias("c")
    joined = keyed.alias("d").join(found, F.col("d.key").eqNullSafe(F.col("c.key")) & (F.col("d.th") == F.col("c.th")), "left").select(
        "d.key", "d.text", "d.kept", "c.rules"
    )
    none = F.array().cast("array<string>")
    parts = []
    for i, rule in enumerate(rules):
        open_ = F.coalesce(F.array_contains("rules", i), F.lit(False)) if derive(rule.pattern) is not None else F.col("text").rlike(rule.pattern)
        pattern = F.lit(rule.pattern)
        parts += [
            F.when(open_, F.split("text", rule.pattern, -1)).otherwise(none).alias(f"pieces{i}"),
            F.when(open_, F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none).alias(f"found{i}"),
            F.when(open_, F.regexp_extract_all("text", pattern, F.lit(rule.group))).otherwise(none).alias(f"groups{i}"),
        ]
    cut = joined.select("key", "kept", *parts)
    spans = F.concat(*[_spans(rule, i, f"pieces{i}", f"found{i}", f"groups{i}") for i, rule in enumerate(rules)])
    return cut.select("key", "kept", F.array_sort(spans).alias("spans"))


def written(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    count = lambda i: F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)], F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with each secret replaced by ``[kind]``; every other character stays. Columns as in ``docs``.

    Overlapping spans of different rules become one, named after the first.
    """
    found = scanned(docs, "doc_id", text, keep=tuple(docs.columns))
    raw = F.col(f"kept.c{docs.columns.index(text)}")
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substr(raw, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        add = F.concat(state["out"], F.array(gap, F.concat(F.lit("["), F.get(kinds, s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], add).otherwise(state["out"]).alias("out"))

    done = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.array(F.substr(raw, s["at"] + 1, F.length(raw)))))
    clean = F.when(F.size("spans") > 0, F.array_join(done, "")).otherwise(raw)
    return found.select(*[(clean if c == text else F.col(f"kept.c{i}")).alias(c) for i, c in enumerate(docs.columns)])
