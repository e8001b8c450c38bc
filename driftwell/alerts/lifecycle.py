"""Stored alerts: reconciling with what was found, roll-up by revision, sending, delivery."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maths import alert_score, bayesian_add, significant_difference

ALERTS = "tdad_id string, reason string, revision string, severity double, confidence double, details string, status string, create_time timestamp, last_updated timestamp, last_sent timestamp, solution string"
KEY = ["tdad_id", "reason"]
#: How sure and grave an alert must be to be sent, and how many are sent at once.
SEND_CONFIDENCE, SEND_SEVERITY, SEND_SLACK, SEND_MOST, SEND_DAYS = 0.90, 0.70, 1e-4, 10, 30
ROLLUP_SEVERITY = 0.7


def reconcile(stored: DataFrame, found: DataFrame, reason: str, now: Column) -> DataFrame:
    """The whole table after a run of one rule, with ``change``: new, changed, revived, obsolete or none.

    An unsolved alert that is found again is rewritten when its severity or confidence moved significantly, or when it was
    obsolete; one that is not found any more becomes obsolete. Solved alerts and other rules' alerts stay as they are.
    """
    s, f = stored.alias("s"), found.filter(F.col("reason") == reason).dropDuplicates(KEY).alias("f")
    both = s.join(f, (F.col("s.tdad_id") == F.col("f.tdad_id")) & (F.col("s.reason") == F.col("f.reason")), "full_outer")
    mine, old, new = F.col("s.reason") == reason, F.col("s.tdad_id").isNotNull(), F.col("f.tdad_id").isNotNull()
    solved = F.coalesce(F.length(F.trim("s.solution")) > 0, F.lit(False))
    moved = significant_difference(F.col("s.severity"), F.col("f.severity")) | significant_difference(F.col("s.confidence"), F.col("f.confidence"))
    change = (
        F.when(~old, "new").when(~mine | solved, "none").when(~new, F.when(F.col("s.status") == "obsolete", "none").otherwise("obsolete"))
        .when(F.col("s.status") == "obsolete", "revived").when(moved, "changed").otherwise("none")
    )
    both = both.withColumn("change", change)
    taken = F.col("change").isin("new", "changed", "revived")
    pick = lambda c: F.when(taken, F.col(f"f.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    return both.select(
        F.coalesce("s.tdad_id", "f.tdad_id").alias("tdad_id"), F.coalesce("s.reason", "f.reason").alias("reason"),
        *[pick(c) for c in ("revision", "severity", "confidence", "details")],
        F.when(taken, "new").when(F.col("change") == "obsolete", "obsolete").otherwise(F.col("s.status")).alias("status"),
        F.coalesce("s.create_time", now).alias("create_time"), F.when(F.col("change") != "none", now).otherwise(F.col("s.last_updated")).alias("last_updated"),
        "s.last_sent", "s.solution", "change",
    )


def roll_up(alerts: DataFrame, source: str, reason: str, test: str, tests: DataFrame | None = None) -> DataFrame:
    """One alert per revision of the live alerts of a rule: its tests by falling confidence, the worst of each test.

    ``test``: the field of ``details`` that names the test; ``tests``: (revision, n), how many tests ran on it.
    """
    live = alerts.filter((F.col("reason") == source) & (F.col("status") != "obsolete"))
    named = live.withColumn("test", F.get_json_object("details", f"$.{test}"))
    worst = named.groupBy("revision", "test").agg(F.max_by(F.struct("tdad_id", "confidence", "details"), F.struct("confidence", "tdad_id")).alias("w"))
    one = F.struct((-F.col("w.confidence")).alias("order"), F.col("test").alias("test"), F.col("w.tdad_id").alias("tdad_id"), F.col("w.confidence").alias("confidence"))
    by = worst.groupBy("revision").agg(F.array_sort(F.collect_list(one)).alias("parts"), F.count(F.lit(1)).alias("bad"), F.max("w.confidence").alias("confidence"))
    by = by.join(tests, "revision", "left") if tests is not None else by.withColumn("n", F.lit(None).cast("long"))
    listed = F.transform("parts", lambda p: F.struct(p["test"].alias("test"), p["confidence"].alias("confidence")))
    return by.select(
        F.col("revision").alias("tdad_id"), F.lit(reason).alias("reason"), "revision", F.lit(ROLLUP_SEVERITY).alias("severity"), "confidence",
        F.to_json(F.struct(F.col("n").alias("total_tests"), F.col("bad").alias("total_exceptions"), listed.alias("tests"))).alias("details"),
    )


def hierarchy(alerts: DataFrame, parent: str, child: str, linked: DataFrame) -> DataFrame:
    """(parent, child) ids of alerts of one revision that are not linked yet."""
    p = alerts.filter((F.col("reason") == parent) & (F.col("status") != "obsolete")).select(F.col("tdad_id").alias("parent"), "revision")
    c = alerts.filter((F.col("reason") == child) & (F.col("status") != "obsolete")).select(F.col("tdad_id").alias("child"), "revision")
    return p.join(c, "revision").select("parent", "child").join(linked, ["parent", "child"], "left_anti")


def to_send(alerts: DataFrame, reasons: list[str], now: Column, most: int = SEND_MOST) -> DataFrame:
    """The alerts that are due, gravest first: live, unsolved, never sent, recent, and important enough."""
    limit = bayesian_add(F.lit(SEND_CONFIDENCE), F.lit(SEND_SEVERITY)) - SEND_SLACK
    important = bayesian_add(F.col("severity"), F.least(F.col("confidence"), F.lit(0.999999)))
    due = alerts.filter(
        F.col("reason").isin(*reasons) & (F.col("status") != "obsolete") & F.col("last_sent").isNull() & (F.coalesce(F.length(F.trim("solution")), F.lit(0)) == 0)
        & (F.col("last_updated") > now - F.make_dt_interval(F.lit(SEND_DAYS))) & (important > limit)
    )
    return due.withColumn("score", alert_score(F.col("severity"), F.col("confidence"))).orderBy(F.desc("score"), "tdad_id", "reason").limit(most)


def mark_sent(alerts: DataFrame, sent: DataFrame, now: Column) -> DataFrame:
    """``last_sent`` of the sent alerts, all at one time."""
    keys = sent.select(*KEY, F.lit(True).alias("sent_"))
    return alerts.join(keys, KEY, "left").withColumn("last_sent", F.when(F.col("sent_"), now).otherwise(F.col("last_sent"))).drop("sent_")


def queue(sent: DataFrame, listeners: DataFrame, subject: str) -> DataFrame:
    """(id, to, subject, body) for the mail queue: recipients of each reason, joined by semicolons; none: no mail."""
    to = listeners.groupBy("reason").agg(F.array_join(F.array_sort(F.collect_set("email")), ";").alias("to"))
    return sent.join(to, "reason").select(F.xxhash64("tdad_id", "reason").alias("id"), "to", F.concat(F.lit(subject), F.lit(" "), F.col("revision")).alias("subject"), F.col("details").alias("body"))


def deliver(content: DataFrame, delivery: DataFrame, send: Callable[[str, list[str], str], None], now: Column) -> DataFrame:
    """Send what is unsent (a driver-side effect on few rows) and return the content table with ``date_sent`` set."""
    ready = content.filter("date_sent is null").join(delivery, content["id"] == delivery["content"]).groupBy("id", "subject", "body").agg(F.array_sort(F.collect_set("deliver_to")).alias("to"))
    for row in ready.orderBy("id").toLocalIterator():
        send(row["subject"], list(row["to"]), row["body"])
    ids = ready.select("id", F.lit(True).alias("done_"))
    return content.join(ids, "id", "left").withColumn("date_sent", F.when(F.col("done_"), now).otherwise(F.col("date_sent"))).drop("done_")
