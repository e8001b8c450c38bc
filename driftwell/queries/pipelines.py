"""Sinks and changes, detection and alerts, incremental evaluation."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..alerts import detect, lifecycle
from ..operators.stored import shared, stored
from ..sources import sinks
from ..sources.store import Store
from ..streaming import incremental
from .registry import Tables, query


def scratch(t: Tables) -> str:
    """A folder that all executors see."""
    return f"{shared(t.spark)}/query-{uuid.uuid4().hex}"


@query("""SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN 'THREE' ELSE n_name END AS n_name, CASE WHEN n_nationkey >= 100 THEN 1 END AS extra FROM
  (SELECT n_nationkey, n_name FROM nation UNION ALL SELECT 100, 'NOWHERE' UNION ALL SELECT 101, NULL) WHERE n_nationkey <> 5""")
def store_changes(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t))
    store.insert("n", t.nation.select("n_nationkey", "n_name"))
    store.insert("n", t.spark.createDataFrame([(100, "NOWHERE", 1)], "n_nationkey int, n_name string, extra int"))
    store.insert_new("n", t.spark.createDataFrame([(100, "AGAIN", 2), (101, None, 1)], "n_nationkey int, n_name string, extra int"), ["n_nationkey"])
    store.update_slice("n", {"n_nationkey": 3}, {"n_name": "THREE"})
    return store.delete("n", F.col("n_nationkey") == 5)


@query("""SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 AND o_orderstatus <> 'F' THEN 'large' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN o_totalprice >= 200000 AND o_orderstatus <> 'F' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey FROM orders""")
def store_update_query(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t))
    store.write("o", t.orders.select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice", "o_orderstatus"))
    where = {"and": [{"range": {"o_totalprice": {"gte": 200000}}}, {"not": {"term": {"o_orderstatus": "F"}}}]}
    return store.update_query("o", {"set": {"o_orderpriority": "large", "o_custkey": {"script": "o_custkey + 1"}}, "where": where}).select("o_orderkey", "o_orderpriority", "o_custkey")


@query("""SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS n_name FROM nation""")
def store_merge_and_versions(t: Tables) -> DataFrame:
    store = Store(t.spark, scratch(t))
    store.write("n", t.nation.select("n_nationkey", "n_name"))
    store.merge("n", t.nation.filter("n_regionkey = 1").select("n_nationkey", F.concat(F.upper("n_name"), F.lit("!")).alias("n_name")), ["n_nationkey"])
    store.delete("n", F.lit(True))
    store.rollback("n")
    store.prune("n")
    store.alias("nation_now", "n")
    return t.spark.table("nation_now")


@query("""SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '1997-01-01' AND o_orderstatus = 'O' THEN 'late' ELSE o_orderpriority END AS o_orderpriority,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderdate >= DATE '1997-01-01' THEN o_custkey END AS o_custkey FROM orders
  JOIN customer ON o_custkey = c_custkey WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 50)""")
def store_partial_changes(t: Tables) -> DataFrame:
    """Orders arrive by year; a new column, changes by key and by filter write anew only the folders that hold such orders."""
    store, keep = Store(t.spark, scratch(t)), ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]
    orders = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    store.write("o", orders.filter("o_orderdate < '1995-01-01'").select(*keep), keys=["o_orderkey", "o_orderdate"])
    store.insert("o", orders.filter("o_orderdate >= '1995-01-01' AND o_orderdate < '1997-01-01'").select(*keep))
    store.add_column("o", "o_custkey", t.orders.schema["o_custkey"].dataType.simpleString())
    store.merge("o", orders.filter("o_orderdate >= '1997-01-01'").select(*keep, "o_custkey"), ["o_orderkey"])
    store.update("o", (F.col("o_orderdate") >= "1997-01-01") & (F.col("o_orderstatus") == "O"), {"o_orderpriority": "late"})
    store.update_join("o", orders.filter("c_mktsegment = 'BUILDING'").select("o_orderkey", F.lit(0).cast(t.orders.schema["o_totalprice"].dataType).alias("o_totalprice")), ["o_orderkey"], ["o_totalprice"])
    return store.delete_in("o", t.lineitem.filter("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"]).select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")


@query("""SELECT event_id AS eventid, nullif(trim(CASE WHEN event_type = 'view' THEN ' ' ELSE event_type END), '') AS kind, list_sort([user_id % 3, value::BIGINT]) AS list FROM events""")
def sink_scrub(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("event_id").alias("EventId"), F.when(F.col("event_type") == "view", " ").otherwise(F.col("event_type")).alias("Kind"), F.array(F.col("user_id") % 3, F.lit(None).cast("long"), F.rint("value").cast("long")).alias("List"))
    return sinks.scrub(rows)


@query("""SELECT n_nationkey || chr(9) || '"' || n_name || '"' || chr(9) || 'null' AS value FROM nation""")
def sink_tabs(t: Tables) -> DataFrame:
    return sinks.tab_cells(t.nation.select("n_nationkey", "n_name", F.lit(None).cast("string").alias("none")))


@query("""SELECT 'r_regionkey' AS r_regionkey, 'r_name' AS r_name UNION SELECT r_regionkey::VARCHAR, r_name FROM region""")
def sink_header_rows(t: Tables) -> DataFrame:
    return sinks.header_and_rows(t.region.select("r_regionkey", "r_name"))


@query("""SELECT r_regionkey::BIGINT AS content, unnest(['a@x', 'b@x']) AS deliver_to FROM region""")
def sink_mail(t: Tables) -> DataFrame:
    rows = t.region.select(F.col("r_regionkey").cast("long").alias("id"), F.lit("a@x; b@x;;a@x").alias("to"), F.lit("s").alias("subject"), F.col("r_name").alias("body"))
    return sinks.mail(rows)[1]


RULE = detect.Rule(window=10, trigger=7.8)


def shifted(t: Tables) -> DataFrame:
    rows = t.events.withColumn("revision", F.concat(F.lit("r"), F.floor(F.col("event_id") / 50)))
    return detect.shifts(rows, ["event_type"], ["ts", "event_id"], "value", RULE, "revision")


PAST = "PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING"
FUTURE = "PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING"


@query(f"""SELECT event_id, CASE WHEN len(p) < 3 OR len(f) < 3 THEN 0.0 ELSE round(2 * (lp - len(p) / 2.0) ** 2 / (len(p) / 2.0) + 2 * (lf - len(f) / 2.0) ** 2 / (len(f) / 2.0), 6) END AS statistic, date_max, past_revision FROM
  (SELECT *, list_sum(list_transform(p, lambda x: CASE WHEN x < med THEN 1.0 WHEN x = med THEN 0.5 ELSE 0.0 END)) AS lp, list_sum(list_transform(f, lambda x: CASE WHEN x < med THEN 1.0 WHEN x = med THEN 0.5 ELSE 0.0 END)) AS lf FROM
  (SELECT *, list_median(list_concat(p, f)) AS med FROM (SELECT event_id, coalesce(list(value) OVER ({PAST}), []) AS p, list(value) OVER ({FUTURE}) AS f, max(ts) OVER ({FUTURE}) AS date_max,
    lag('r' || floor(event_id / 50)::BIGINT) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS past_revision FROM events)))""")
def detect_shifts(t: Tables) -> DataFrame:
    return shifted(t).select("event_id", F.round("statistic", 6).alias("statistic"), "date_max", "past_revision")


@query()
def detect_alerts(t: Tables) -> DataFrame:
    """Alerts of sustained shifts; the confidence has no SQL."""
    return detect.found(shifted(t), ["event_type"], "sustained", "revision")


@query("""SELECT event_id::VARCHAR AS tdad_id, 'limit' AS reason, event_type AS revision, 0.6::DOUBLE AS severity FROM events WHERE (event_type = 'click' AND value > 80) OR (event_type = 'view' AND value > 95)""")
def detect_thresholds(t: Tables) -> DataFrame:
    limits = t.spark.createDataFrame([("click", 80.0, 0.6), ("view", 95.0, 0.6)], "page string, threshold double, severity double")
    rows = t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("page"), F.col("event_type").alias("revision"), "value")
    return detect.thresholds(rows, limits, "page", "value", "limit").select("tdad_id", "reason", "revision", "severity")


NOW = dt.datetime(2024, 6, 1)


def stored_alerts(t: Tables) -> DataFrame:
    """One alert from each order: a key, a status, a solution here and there."""
    one = F.lit(NOW).cast("timestamp")
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("tdad_id"), F.lit("sustained").alias("reason"), F.concat(F.lit("r"), F.col("o_custkey") % 40).alias("revision"), F.lit(0.8).alias("severity"),
        ((F.col("o_orderkey") % 97 + 1) / 100.0).alias("confidence"), F.to_json(F.struct(F.col("o_orderpriority").alias("test"))).alias("details"), F.when(F.col("o_orderstatus") == "P", "obsolete").otherwise("new").alias("status"),
        one.alias("create_time"), (one - F.make_dt_interval(F.col("o_orderkey").cast("int") % 60)).alias("last_updated"), F.when(F.col("o_orderkey") % 30 == 0, one).alias("last_sent"), F.when(F.col("o_orderkey") % 70 == 0, F.lit("done")).alias("solution"),
    )


ALERTS = """(SELECT o_orderkey AS k, o_orderkey::VARCHAR AS tdad_id, 'r' || o_custkey % 40 AS revision, (o_orderkey % 97 + 1) / 100.0 AS confidence, o_orderpriority AS test,
  CASE WHEN o_orderstatus = 'P' THEN 'obsolete' ELSE 'new' END AS status, o_orderkey % 60 AS age, o_orderkey % 30 = 0 AS sent, o_orderkey % 70 = 0 AS solved FROM orders)"""


@query(f"""SELECT tdad_id, CASE WHEN solved OR (k % 20 <> 0 AND status = 'obsolete') THEN 'none' WHEN k % 20 <> 0 THEN 'obsolete' WHEN status = 'obsolete' THEN 'revived' ELSE 'none' END AS change FROM {ALERTS}
  UNION ALL SELECT 'fresh', 'new'""")
def alerts_reconciled(t: Tables) -> DataFrame:
    old = stored_alerts(t)
    pick = ["tdad_id", "reason", "revision", "severity", "confidence", "details"]
    again = old.filter("cast(tdad_id as long) % 20 = 0").select(*pick)
    fresh = t.spark.createDataFrame([("fresh", "sustained", "r1", 0.8, 0.9, "{}")], again.schema)
    return lifecycle.reconcile(old, again.unionByName(fresh), "sustained", F.lit(NOW).cast("timestamp")).select("tdad_id", "change")


@query(f"""SELECT revision AS tdad_id, round(max(confidence), 9)::DOUBLE AS confidence, count(DISTINCT test) AS bad FROM {ALERTS} WHERE status <> 'obsolete' GROUP BY 1""")
def alerts_rolled_up(t: Tables) -> DataFrame:
    up = lifecycle.roll_up(stored_alerts(t), "sustained", "revision", "test")
    return up.select("tdad_id", F.round("confidence", 9).alias("confidence"), F.get_json_object("details", "$.total_exceptions").cast("long").alias("bad"))


@query(f"""SELECT tdad_id FROM (SELECT *, 0.8 * c / (0.8 * c + 0.2 * (1 - c)) AS p FROM (SELECT *, confidence::DOUBLE AS c FROM {ALERTS})) WHERE status <> 'obsolete' AND NOT sent AND NOT solved AND age < 30 AND p > 0.9 * 0.7 / (0.9 * 0.7 + 0.1 * 0.3) - 1e-4 ORDER BY p DESC, tdad_id LIMIT 10""")
def alerts_to_send(t: Tables) -> DataFrame:
    return lifecycle.to_send(stored_alerts(t), ["sustained"], F.lit(NOW).cast("timestamp")).select("tdad_id")


@query(f"""SELECT revision AS parent, tdad_id AS child FROM {ALERTS} WHERE status <> 'obsolete' AND revision <> 'r3'""")
def alerts_hierarchy(t: Tables) -> DataFrame:
    old = stored_alerts(t)
    up = lifecycle.roll_up(old, "sustained", "revision", "test").withColumn("status", F.lit("new"))
    both = old.unionByName(up, allowMissingColumns=True)
    linked = old.filter("revision = 'r3'").select(F.col("revision").alias("parent"), F.col("tdad_id").alias("child"))
    return lifecycle.hierarchy(both, "revision", "sustained", linked)


@query("""SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def stream_new_files(t: Tables) -> DataFrame:
    """Two files arrive one after the other; each batch adds to a table by event type."""
    root = scratch(t)
    store, schema = Store(t.spark, f"{root}/store"), ", ".join(f"{n} {k}" for n, k in t.events.dtypes)

    def batch(rows: DataFrame, number: int) -> None:
        store.insert("sums", rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")), batch=("files", number))

    for part in (0, 1):
        t.events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{root}/in")
        incremental.run_available(t.spark, f"{root}/in", schema, f"{root}/progress", batch)
    return store.read("sums").groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("""SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) e JOIN
  (SELECT event_type, min(n) AS first FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE event_id >= 9000 GROUP BY 1) f USING (event_type) WHERE n >= first - 20""")
def stream_look_back(t: Tables) -> DataFrame:
    done = t.events.filter("event_id < 9000").select("event_id")
    fresh = incremental.unmarked(t.events, done, ["event_id"])
    return incremental.with_look_back(t.events, fresh, ["event_type"], "event_id", 20).select("event_id")


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '2000-01-01') AS start, count(*) AS n FROM events GROUP BY 1, 2""")
def stream_tumbling(t: Tables) -> DataFrame:
    root = scratch(t)
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    rows.write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema("ts timestamp, event_type string").parquet(f"{root}/in")
    name = f"w_{uuid.uuid4().hex}"
    counts = incremental.tumbling(stream, "ts", "1 day", "1 day", ["event_type"], F.count(F.lit(1)).alias("n"))
    q = counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start()
    q.awaitTermination()
    return stored(t.spark.table(name)).select("event_type", F.col("window.start").alias("start"), "n")
