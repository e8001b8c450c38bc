"""Windows, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import windows
from ..operators.joins import arg_max, latest
from .language import engine
from .registry import Tables, query

W_TYPE = "PARTITION BY event_type ORDER BY ts, event_id"


@query(f"""SELECT event_id, row_number() OVER w - 1 AS n, lag(value) OVER w AS before, lead(value, 2) OVER w AS later, value - lag(value) OVER w AS step FROM events WINDOW w AS ({W_TYPE})""")
def window_calculated(t: Tables) -> DataFrame:
    over = {"edges": ["event_type"], "sort": ["ts", "event_id"]}
    q = {"from": "events", "select": ["event_id", "n", "before", "later", "step"], "window": [
        {"name": "n", "value": lambda r: r.rownum, **over}, {"name": "before", "value": lambda r: r.shift("value", -1), **over},
        {"name": "later", "value": lambda r: r.shift("value", 2), **over}, {"name": "step", "value": {"script": "value - before"}},
    ]}
    return engine(t, "events").run(q)


@query(f"""SELECT event_id, round(coalesce(sum(value) OVER w, 0), 4) AS total, count(value) OVER w AS n, max(value) OVER w AS hi, min(value) OVER w AS lo
  FROM events WINDOW w AS ({W_TYPE} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def window_sliding(t: Tables) -> DataFrame:
    over = {"edges": ["event_type"], "sort": ["ts", "event_id"], "value": "value", "range": {"min": -10, "max": 0}}
    q = {"from": "events", "select": ["event_id", "total", "n", "hi", "lo"], "window": [{"name": n, "aggregate": a, **over} for n, a in (("total", "Sum"), ("n", "Count"), ("hi", "Max"), ("lo", "Min"))]}
    return engine(t, "events").run(q).withColumn("total", F.round("total", 4))


@query("""SELECT event_id, count(*) OVER (PARTITION BY event_type) AS n, round(avg(value) OVER (PARTITION BY event_type), 6) AS m FROM events""")
def window_whole_partition(t: Tables) -> DataFrame:
    w = [{"name": "n", "value": "event_id", "aggregate": "count", "edges": ["event_type"]}, {"name": "m", "value": "value", "aggregate": "mean", "edges": ["event_type"]}]
    return engine(t, "events").run({"from": "events", "select": ["event_id", "n", "m"], "window": w}).withColumn("m", F.round("m", 6))


@query(f"""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN coalesce(sum(CASE WHEN user_id % 2 = 0 THEN 1 END) OVER (PARTITION BY event_type, user_id % 2 ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 0)::BIGINT END AS n FROM events""")
def window_filtered(t: Tables) -> DataFrame:
    w = {"name": "n", "value": {"script": "if(user_id is null, 0, 1)"}, "aggregate": "sum", "edges": ["event_type"], "sort": ["ts", "event_id"], "range": {"min": -5, "max": 1}, "where": {"script": "mod(user_id, 2) = 0"}}
    return engine(t, "events").run({"from": "events", "select": ["event_id", "n"], "window": [w]})


@query(f"""SELECT event_id, count(value) OVER w::DOUBLE AS n, round(avg(value) OVER w, 6) AS mean, CASE WHEN count(value) OVER w > 1 THEN round(var_pop(value) OVER w, 4) END AS variance
  FROM events WINDOW w AS ({W_TYPE} ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)""")
def window_stats(t: Tables) -> DataFrame:
    w = {"name": "s", "value": "value", "aggregate": "stats", "edges": ["event_type"], "sort": ["ts", "event_id"], "range": {"min": 0, "max": 10}}
    out = engine(t, "events").run({"from": "events", "select": ["event_id", {"name": "s", "value": "s"}], "window": [w]})
    return out.select("event_id", F.col("s.count").alias("n"), F.round("s.mean", 6).alias("mean"), F.round("s.variance", 4).alias("variance"))


@query(f"""SELECT event_id, n - 2 * off AS kept, round(list_avg(sorted[off + 1 : n - off]), 6) AS mean FROM (SELECT event_id, sorted, len(sorted) AS n, ceil(len(sorted) * 0.2)::INT AS off FROM
  (SELECT event_id, list_sort(list(value) OVER w) AS sorted FROM events WINDOW w AS ({W_TYPE} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))) WHERE 2 * off < n""")
def window_trimmed(t: Tables) -> DataFrame:
    w = {"name": "s", "value": "value", "aggregate": {"middle": 0.6}, "edges": ["event_type"], "sort": ["ts", "event_id"], "range": {"min": -9, "max": 1}}
    out = engine(t, "events").run({"from": "events", "select": ["event_id", {"name": "s", "value": "s"}], "window": [w]})
    return out.select("event_id", F.col("s.stats.count").cast("long").alias("kept"), F.round("s.stats.mean", 6).alias("mean")).filter("kept > 0")


@query(f"""SELECT user_id, event_id, date_diff('second', lag(ts) OVER w, ts) AS gap, date_diff('second', first(ts) OVER w, ts) AS since FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def scan_intervals(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return t.events.select("user_id", "event_id", (seconds - F.lag(seconds).over(w)).alias("gap"), (seconds - F.first(seconds).over(w)).alias("since"))


@query("""SELECT prev + 1 AS min, v AS max FROM (SELECT v, lag(v, 1, -1) OVER (ORDER BY v) AS prev FROM (SELECT DISTINCT user_id * 3 AS v FROM events WHERE user_id * 3 BETWEEN 0 AND 2999)) WHERE prev + 1 < v
  UNION ALL SELECT max(user_id * 3) + 1, 3000 FROM events WHERE user_id * 3 BETWEEN 0 AND 2999 HAVING max(user_id * 3) + 1 < 3000""")
def find_holes(t: Tables) -> DataFrame:
    return windows.holes(t.events.select((F.col("user_id") * 3).alias("v")), "v", 0, 3000)


@query(f"""SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, run ORDER BY value DESC, event_id DESC) AS rn FROM (SELECT *, sum(chg) OVER ({W_TYPE}) AS run FROM
  (SELECT *, CASE WHEN (value > 50) IS NOT DISTINCT FROM lag(value > 50) OVER ({W_TYPE}) THEN 0 ELSE 1 END AS chg FROM events))) WHERE value > 50 AND rn = 1""")
def best_of_runs(t: Tables) -> DataFrame:
    flagged = t.events.withColumn("high", F.col("value") > 50)
    return windows.best_of_runs(flagged, ["event_type"], ["ts", "event_id"], "high", [F.desc("value"), F.desc("event_id")]).filter("pass").select("event_id")


@query("""SELECT lo, least(lo + 70, 1000) AS hi FROM (SELECT unnest(range(0, 1000, 70)) AS lo)""")
def intervals(t: Tables) -> DataFrame:
    return t.spark.range(0, 1000, 70).select(F.col("id").alias("lo"), F.least(F.col("id") + 70, F.lit(1000)).alias("hi"))


@query("""SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderpriority ASC NULLS FIRST, o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25""")
def sort_many_keys(t: Tables) -> DataFrame:
    return engine(t, "orders").run({"from": "orders", "select": ["o_orderkey", "o_custkey"], "sort": [{"field": "o_orderpriority", "sort": "asc"}, {"field": "o_clerk", "sort": 0} if "o_clerk" in t.orders.columns else {"field": "o_custkey", "sort": "none"}, {"field": "o_totalprice", "sort": "desc"}, "o_orderkey"], "limit": 25})


@query("""SELECT o_orderkey FROM orders ORDER BY o_totalprice * (1 + o_custkey % 7) DESC, o_orderkey LIMIT 10""")
def top_by_expression(t: Tables) -> DataFrame:
    return t.orders.orderBy((F.col("o_totalprice") * (1 + F.col("o_custkey") % 7)).desc(), "o_orderkey").limit(10).select("o_orderkey")


@query("""SELECT event_type, min(ts) AS start FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 20 GROUP BY 1""")
def start_of_last_rows(t: Tables) -> DataFrame:
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id")))
    return t.events.withColumn("n", n).filter("n <= 20").groupBy("event_type").agg(F.min("ts").alias("start"))


@query("""SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def arg_max_row(t: Tables) -> DataFrame:
    return arg_max(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1""")
def dedupe_to_latest(t: Tables) -> DataFrame:
    return latest(t.orders, ["o_custkey"], F.desc("o_orderkey")).select("o_custkey", "o_orderkey")
