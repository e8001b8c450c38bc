"""Joins, set operations, and the report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import jsons
from ..operators import joins, sets
from ..operators.stored import stored, tasks
from .registry import Tables, query


@query("""SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def join_inner(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("""SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' GROUP BY 1""")
def join_left(t: Tables) -> DataFrame:
    open_ = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(open_, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("""SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal * 40 < o_totalprice""")
def join_theta(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_acctbal") * 40 < F.col("o_totalprice"))).select("o_orderkey", "c_custkey")


@query("""SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def join_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def join_semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("""SELECT r_name, p_brand, count(*) AS n FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def join_star(t: Tables) -> DataFrame:
    on = lambda a, b: F.col(a) == F.col(b)
    wide = t.lineitem.join(t.orders, on("l_orderkey", "o_orderkey"), "left").join(t.customer, on("o_custkey", "c_custkey"), "left").join(t.nation, on("c_nationkey", "n_nationkey"), "left")
    wide = wide.join(t.region, on("n_regionkey", "r_regionkey"), "left").join(t.part, on("l_partkey", "p_partkey"), "left")
    return wide.groupBy("r_name", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT a.o_orderkey AS x, b.o_orderkey AS y FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority AND a.o_orderstatus = b.o_orderstatus AND a.o_orderkey < b.o_orderkey""")
def join_self(t: Tables) -> DataFrame:
    a, b = t.orders.alias("a"), t.orders.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("o_custkey", "o_orderpriority", "o_orderstatus")]
    return a.join(b, same[0] & same[1] & same[2] & (F.col("a.o_orderkey") < F.col("b.o_orderkey"))).select(F.col("a.o_orderkey").alias("x"), F.col("b.o_orderkey").alias("y"))


BANDS = [(0.0, 12.5), (12.5, 40.0), (35.0, 75.0), (90.0, 400.0)]


@query("""SELECT event_id, lo FROM events LEFT JOIN (VALUES (0.0, 12.5), (12.5, 40.0), (35.0, 75.0), (90.0, 400.0)) b(lo, hi) ON lo <= value AND value < hi""")
def join_band(t: Tables) -> DataFrame:
    # Written in the plan, whose size Spark knows: the four bands are broadcast, and events are not shuffled.
    bands = t.spark.sql(f"SELECT CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi FROM VALUES {', '.join(map(str, BANDS))} AS b(lo, hi)")
    return joins.band_join(t.events.select("event_id", "value"), "value", bands, "lo", "hi", 10.0).select("event_id", "lo")


@query("""SELECT a.event_id, b.value AS last_click FROM (SELECT * FROM events WHERE event_type = 'purchase') a ASOF LEFT JOIN
  (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'click' GROUP BY 1, 2) b ON a.user_id = b.user_id AND a.ts >= b.ts""")
def join_asof(t: Tables) -> DataFrame:
    left = t.events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = t.events.filter("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("value").alias("last_click"))
    return joins.asof_join(left, right, ["user_id"], "ts", ["last_click"]).select("event_id", "last_click")


@query("""SELECT DISTINCT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING'""")
def join_image(t: Tables) -> DataFrame:
    some = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_nationkey")
    return joins.image(some, "c_nationkey", t.nation, "n_nationkey", "n_name")


@query("""SELECT p, s FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) CROSS JOIN (SELECT DISTINCT o_orderstatus AS s FROM orders)""")
def all_edge_combinations(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderpriority").alias("p")).distinct().crossJoin(t.orders.select(F.col("o_orderstatus").alias("s")).distinct())


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def set_difference(t: Tables) -> DataFrame:
    return sets.difference(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def set_intersection(t: Tables) -> DataFrame:
    return sets.intersection(t.customer.select("c_custkey", "c_name"), t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""SELECT n_nationkey, n_name FROM nation WHERE n_nationkey < 15 UNION SELECT n_nationkey, n_name FROM nation WHERE n_nationkey > 9""")
def set_union(t: Tables) -> DataFrame:
    n = t.nation.select("n_nationkey", "n_name")
    return sets.union(n.filter("n_nationkey < 15"), n.filter("n_nationkey > 9"), ["n_nationkey"])


@query("""SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def set_bag_difference(t: Tables) -> DataFrame:
    one = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return one("F").exceptAll(one("O"))


@query("""SELECT r_regionkey AS k, r_name AS name, NULL AS extra FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def set_union_all(t: Tables) -> DataFrame:
    return sets.union_all(t.region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name")), t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("extra")))


@query("""SELECT event_type, min(event_id) AS event_id FROM events GROUP BY 1""")
def set_ordered(t: Tables) -> DataFrame:
    return sets.ordered_set(t.events, "event_type", "event_id")


@query("""SELECT DISTINCT user_id FROM events WHERE event_id >= 5000 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id < 5000)""")
def set_net_new(t: Tables) -> DataFrame:
    return sets.net_new(t.events.filter("event_id >= 5000").select("user_id"), t.events.filter("event_id < 5000").select("user_id"), ["user_id"])


@query("""SELECT o_orderpriority AS value, list_sort(list(DISTINCT o_orderstatus)) AS keys FROM orders GROUP BY 1""")
def set_invert(t: Tables) -> DataFrame:
    by = t.orders.groupBy("o_orderstatus").agg(F.collect_set("o_orderpriority").alias("all_"))
    return sets.invert(by, "o_orderstatus", "all_")


# Reports ----------------------------------------------------------------------------------------------------------
@query("""SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'view' AND user_id < 100""")
def report_test_data(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'view' and user_id < 100").select("event_id", "ts", "user_id", "event_type", "value").orderBy("event_type", "user_id", "ts", "event_id", "value")


@query("""SELECT event_id, props[1:20] AS head, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events ORDER BY event_id LIMIT 100""")
def report_object_store(t: Tables) -> DataFrame:
    return t.events.orderBy("event_id").limit(100).select("event_id", F.substring("props", 1, 20).alias("head"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, k LIMIT 20""")
def report_top_keys(t: Tables) -> DataFrame:
    return t.events.groupBy(F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "k").limit(20)


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS day, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views FROM events GROUP BY 1""")
def report_by_day(t: Tables) -> DataFrame:
    n = lambda v: F.count(F.when(F.col("event_type") == v, 1))
    return t.events.groupBy(F.date_trunc("day", "ts").alias("day")).agg(n("click").alias("clicks"), n("view").alias("views"))


@query("""SELECT minutes, count(*) AS users FROM (SELECT user_id, floor(date_diff('second', min(ts), max(ts)) / 86400.0)::BIGINT AS minutes FROM events GROUP BY 1) GROUP BY 1""")
def report_spans(t: Tables) -> DataFrame:
    span = F.floor((F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.min("ts").cast("timestamp"))) / 86400.0)
    return t.events.groupBy("user_id").agg(span.alias("minutes")).groupBy("minutes").agg(F.count(F.lit(1)).alias("users"))


@query("""SELECT user_id, event_type, round(m, 6) AS m, n, round(m / t, 6) AS ratio FROM (SELECT user_id, event_type, avg(value) AS m, count(*) AS n FROM events GROUP BY 1, 2)
  LEFT JOIN (SELECT event_type, avg(value) AS t FROM events GROUP BY 1) USING (event_type) WHERE user_id NOT IN (1, 2, 3) AND event_type IN ('click', 'purchase')""")
def report_ratios(t: Tables) -> DataFrame:
    some = t.events.filter("user_id not in (1, 2, 3) and event_type in ('click', 'purchase')")
    per = some.groupBy("user_id", "event_type").agg(F.avg("value").alias("m"), F.count(F.lit(1)).alias("n"))
    all_ = t.events.groupBy("event_type").agg(F.avg("value").alias("t"))
    return per.join(all_, "event_type", "left").select("user_id", "event_type", F.round("m", 6).alias("m"), "n", F.round(F.col("m") / F.col("t"), 6).alias("ratio"))


@query("""SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1, 2 HAVING count(*) > 1""")
def report_duplicates(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last")).filter("n > 1")


@query("""SELECT o_orderkey, c_name, n_name, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned, coalesce(max(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0) AS kept
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1, 2, 3""")
def report_wide_facts(t: Tables) -> DataFrame:
    """Orders not loaded yet, with the largest quantities of two flags as columns. Orders and lines are dealt by order into tasks of bounded size."""
    n, flag = tasks(t.lineitem), lambda f: F.max(F.when(F.col("l_returnflag") == f, F.col("l_quantity")))
    orders = t.orders.repartition(n, "o_orderkey")
    new = orders.join(orders.filter("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", "left_anti")
    eav = t.lineitem.repartition(n, "l_orderkey").groupBy("l_orderkey").agg(flag("R").alias("R"), flag("N").alias("N"))
    wide = new.join(eav, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return wide.select("o_orderkey", "c_name", "n_name", F.col("R").alias("returned"), F.coalesce("N", F.lit(0)).alias("kept"))


@query("""SELECT event_id, v[1] AS v0, v[3] AS v2, v[9] AS v8 FROM (SELECT event_id, list_value(value, value + 1, value + 2) AS v FROM events)""")
def report_array_elements(t: Tables) -> DataFrame:
    v = F.array(F.col("value"), F.col("value") + 1, F.col("value") + 2)
    return t.events.select("event_id", *[F.get(v, F.lit(i)).alias(f"v{i}") for i in (0, 2, 8)])


@query("""SELECT l_orderkey, l_linenumber, o_orderdate::TIMESTAMP AS pushed, c_name, n_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  WHERE n_name = (SELECT min(n_name) FROM nation) ORDER BY o_orderdate DESC, l_orderkey, l_linenumber LIMIT 1000""")
def report_push_log(t: Tables) -> DataFrame:
    """The newest 1000 lines of one nation's orders, newest first: the report's own length."""
    first = t.nation.select("n_nationkey", "n_name").join(t.nation.agg(F.min("n_name").alias("first")), F.col("n_name") == F.col("first"))
    customers = t.customer.join(first, F.col("c_nationkey") == F.col("n_nationkey"))
    pushes = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.join(pushes, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.orderBy(F.desc("o_orderdate"), "l_orderkey", "l_linenumber").limit(1000).select("l_orderkey", "l_linenumber", F.col("o_orderdate").cast("timestamp").alias("pushed"), "c_name", "n_name")


@query("""SELECT o_orderkey AS id, date_trunc('day', o_orderdate)::TIMESTAMP AS day, o_orderpriority AS test, o_totalprice AS severity FROM orders""")
def report_newest_alerts(t: Tables) -> DataFrame:
    """Alerts newest first, with the date and the test that their details, a JSON text, hold."""
    details = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_orderpriority").alias("test")))
    alerts = t.orders.select(F.col("o_orderkey").alias("id"), details.alias("details"), F.col("o_totalprice").alias("severity"))
    of = lambda name: jsons.string(F.col("details"), name)
    return alerts.select("id", F.to_timestamp(of("day"), "yyyy-MM-dd").alias("day"), of("test").alias("test"), "severity").orderBy(F.desc("id"))


REPLICATES = 25


@query(f"""WITH last AS (SELECT user_id, event_type, max(ts) AS upto FROM events WHERE value > 99 GROUP BY 1, 2)
  SELECT event_id, e.user_id, e.event_type, {", ".join(f"v[{i + 1}] AS r{i}" for i in range(REPLICATES))}
  FROM (SELECT *, [value + x FOR x IN range(event_id % 30)] AS v FROM events) e JOIN last l ON l.user_id = e.user_id AND l.event_type = e.event_type AND e.ts <= l.upto
  WHERE EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase')""")
def report_replicates(t: Tables) -> DataFrame:
    """Each series with an alert (a value over 99) up to its last one, of users that bought: replicates 0 to 24 as columns."""
    series = ["user_id", "event_type"]
    last = t.events.filter("value > 99").groupBy(*series).agg(F.max("ts").alias("upto"))
    raw = stored(t.events.join(last, series).filter("ts <= upto").select("event_id", *series, "value"))
    bought = raw.join(t.events.filter("event_type = 'purchase'").select("user_id"), "user_id", "left_semi")
    n = F.col("event_id") % 30
    rows = bought.withColumn("v", F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0))), lambda x: F.col("value") + x)))
    return rows.select("event_id", *series, *[F.get("v", F.lit(i)).alias(f"r{i}") for i in range(REPLICATES)])


@query("""SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events WHERE value > 90""")
def window_row_number(t: Tables) -> DataFrame:
    return t.events.filter("value > 90").select("event_id", F.row_number().over(W.partitionBy("event_type").orderBy("ts", "event_id")).cast("long").alias("n"))
