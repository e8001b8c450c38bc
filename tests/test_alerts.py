"""Detection and the life of an alert."""

import datetime as dt

from pyspark.sql import functions as F

from driftwell.alerts import detect, lifecycle

NOW = dt.datetime(2024, 5, 1)


def test_one_shift_is_found(spark):
    rows = [("s", i, 100.0 + i % 3 + (50 if i >= 20 else 0), f"r{i}") for i in range(40)] + [("flat", i, 100.0 + i % 3, f"r{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "series string, t long, v double, revision string")
    found = detect.shifts(df, ["series"], ["t"], "v", detect.Rule(), "revision").filter("pass").collect()
    assert [(r["series"], r["t"], r["past_revision"]) for r in found] == [("s", 20, "r19")]
    assert detect.shifts(df, ["series"], ["t"], "v", detect.Rule(better=1), "revision").filter("pass").count() == 0
    assert detect.shifts(df, ["series"], ["t"], "v", detect.Rule(least_percent=80), "revision").filter("pass").count() == 0
    alert = detect.found(detect.shifts(df, ["series"], ["t"], "v", detect.Rule(), "revision"), ["series"], "sustained", "revision").first()
    assert alert["confidence"] > 0.999 and alert["revision"] == "r20"


def alerts(spark):
    day = lambda n: NOW - dt.timedelta(days=n)
    rows = [
        ("sent", "new", 1.0, 0.99, day(1), None), ("never", "new", 1.0, None, day(1), None), ("obsolete", "obsolete", 1.0, None, day(1), None), ("unsure", "new", 0.5, None, day(1), None),
        ("solved", "new", 1.0, None, day(1), "fixed"), ("old", "new", 1.0, None, day(40), None), ("mild", "new", 1.0, None, day(1), None),
    ]
    out = [(k, "r", "rev", 0.1 if k == "unsure" else 0.7, c, "{}", s, NOW, u, NOW if sent else None, sol) for k, s, c, sent, u, sol in rows]
    return spark.createDataFrame(out, lifecycle.ALERTS)


def test_sending(spark):
    stored = alerts(spark)
    due = lifecycle.to_send(stored, ["r"], F.lit(NOW).cast("timestamp"))
    assert sorted(r["tdad_id"] for r in due.collect()) == ["mild", "never"]
    after = lifecycle.mark_sent(stored, due, F.lit(NOW).cast("timestamp"))
    assert lifecycle.to_send(after, ["r"], F.lit(NOW).cast("timestamp")).count() == 0
    for people in ([], ["a@x"], [f"p{i}@x" for i in range(10)]):
        listeners = spark.createDataFrame([("r", p) for p in people], "reason string, email string")
        mail = lifecycle.queue(due, listeners, "alert").collect()
        assert len(mail) == (2 if people else 0) and all(m["to"].count("@") == len(people) for m in mail)


def test_delivery(spark):
    content = spark.createDataFrame([(1, "s", None, "b"), (2, "t", NOW, "c")], "id long, subject string, date_sent timestamp, body string")
    delivery = spark.createDataFrame([(1, "a@x"), (1, "b@x"), (2, "c@x")], "content long, deliver_to string")
    sent = []
    out = lifecycle.deliver(content, delivery, lambda *m: sent.append(m), F.lit(NOW).cast("timestamp"))
    assert sent == [("s", ["a@x", "b@x"], "b")] and out.filter("date_sent is null").count() == 0


def test_thresholds_and_reconciliation(spark):
    limits = spark.createDataFrame([("p", 800.0, 0.5)], "page string, threshold double, severity double")
    rows = spark.createDataFrame([(i, "p", f"r{i}", 700.0 + 50 * i) for i in range(4)], "id long, page string, revision string, mean double")
    found = detect.thresholds(rows, limits, "page", "mean", "limit")
    assert [r["tdad_id"] for r in found.collect()] == ["3"]
    now = F.lit(NOW).cast("timestamp")
    empty = spark.createDataFrame([], lifecycle.ALERTS)
    first = lifecycle.reconcile(empty, found, "limit", now)
    assert [r["change"] for r in first.collect()] == ["new"]
    higher = detect.thresholds(rows, limits.withColumn("threshold", F.lit(900.0)), "page", "mean", "limit")
    second = lifecycle.reconcile(first.drop("change"), higher, "limit", now)
    assert [(r["change"], r["status"]) for r in second.collect()] == [("obsolete", "obsolete")]
    third = lifecycle.reconcile(second.drop("change"), found, "limit", now)
    assert [(r["change"], r["status"]) for r in third.collect()] == [("revived", "new")]
