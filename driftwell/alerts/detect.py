"""Sustained shifts: for each row of a series the window before it is compared with the window from it on.

All series are one scan over blocks of their common order, so that a long series is no single task (``segments``). Rows are ranked on the test's statistic, which needs no special function; the confidence is
computed for the rows that are reported.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import WindowSpec

from ..functions.stats import CHI2_999, chi2_confidence
from ..operators import frames
from ..operators.aggregates import summary
from ..operators.segments import ordered
from ..operators.windows import best_in, frame


@dataclass
class Rule:
    """``better``: 1 when more is better, -1 when less is, 0 for either. A shift counts from ``least`` (absolute) or
    ``least_percent`` of the past mean on. ``disabled`` names series (first edge) that are not tested."""

    window: int = 10
    trigger: float = CHI2_999
    middle: float = 0.60
    better: int = 0
    least: float | None = None
    least_percent: float | None = None
    disabled: tuple = field(default_factory=tuple)


def shifts(df: DataFrame, edges: list[str], order: list[str], value: str, rule: Rule = Rule(), revision: str | None = None, size: int | None = None) -> DataFrame:
    """``size``: rows of a block of the scan, by default as many as suit the table. ``df`` with past and future statistics, the test's statistic, the difference and ``is_diff`` / ``pass``."""
    if rule.disabled:
        df = df.filter(~F.coalesce(F.col(edges[0]).isin(*rule.disabled), F.lit(False)))
    o = ordered(df.withColumn("input_", F.col(value).cast("double")), [F.col(e) for e in edges], [F.col(c) for c in order], size)
    sums = StructType([StructField(s, DoubleType()) for s in frames.SUMS])
    kind = StructType([StructField("past", sums), StructField("future", sums), StructField("statistic", DoubleType())])

    def dates(spec: WindowSpec) -> dict[str, Column]:
        before = {"past_revision": F.lag(revision).over(spec)} if revision else {}
        return {"date_min": F.min(order[0]).over(frame(spec, -rule.window, 0)), "date_max": F.max(order[0]).over(frame(spec, 0, rule.window)), **before}

    o.kernel(frames.shifted("input_", rule.window, rule.middle, "found_"), "found_", kind, rule.window, rule.window, dates)
    out = o.rows.withColumns({"past_stats": summary(F.col("found_.past")), "future_stats": summary(F.col("found_.future")), "statistic": F.col("found_.statistic")})
    out = out.withColumn("diff", F.col("future_stats.mean") - F.col("past_stats.mean"))
    out = out.withColumn("diff_percent", F.try_divide(F.col("diff"), F.col("past_stats.mean")))
    o.rows = out.withColumn("is_diff", F.coalesce((F.col("statistic") > rule.trigger) & is_bad(rule), F.lit(False))).drop("found_", "input_")
    best_in(o, "is_diff", [F.desc("statistic"), F.desc(F.abs("diff")), *[F.desc(c) for c in order]])
    return o.rows.drop("pos_", *o.keys)


def is_bad(rule: Rule) -> Column:
    diff = F.col("diff") * (-rule.better) if rule.better else F.abs("diff")
    if rule.least is not None:
        return diff > rule.least
    if rule.least_percent is not None:
        return diff > F.abs(F.col("past_stats.mean")) * (rule.least_percent / 100)
    return diff > 0 if rule.better else F.lit(True)


def found(shifted: DataFrame, edges: list[str], reason: str, revision: str, severity: float = 0.8, ignored: Column | None = None) -> DataFrame:
    """Alerts of the rows that passed: tdad_id, reason, revision, severity, confidence, details."""
    rows = shifted.filter("pass" if ignored is None else F.col("pass") & ~F.coalesce(ignored, F.lit(False)))
    key = F.to_json(F.struct(*[F.col(e).cast("string").alias(e) for e in sorted([*edges, revision])]))
    return rows.select(
        key.alias("tdad_id"), F.lit(reason).alias("reason"), F.col(revision).cast("string").alias("revision"), F.lit(severity).alias("severity"),
        chi2_confidence("statistic").alias("confidence"), F.to_json(F.struct(*edges, "diff", "diff_percent", "date_min", "date_max")).alias("details"),
    )


def thresholds(measured: DataFrame, limits: DataFrame, key: str, value: str, reason: str, confidence: float = 1.0) -> DataFrame:
    """Alerts of measurements above their key's threshold: an equi-join with the comparison as residual."""
    rows = measured.alias("m").join(limits.alias("l"), (F.col(f"m.{key}") == F.col(f"l.{key}")) & (F.col("l.threshold") < F.col(f"m.{value}")))
    return rows.select(
        F.col("m.id").cast("string").alias("tdad_id"), F.lit(reason).alias("reason"), F.col("m.revision").alias("revision"), F.col("l.severity").alias("severity"),
        F.lit(confidence).alias("confidence"), F.to_json(F.struct(F.col(f"m.{key}").alias("page"), F.col(f"m.{value}").alias("value"), "l.threshold")).alias("details"),
    )
