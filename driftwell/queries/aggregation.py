"""Aggregation: named aggregates, distinct values, pivots, moments, runs, chunks and bags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates, groups
from .language import engine
from .registry import Tables, case_sensitive, query

aggregates.define("geometric", {"sum": lambda c: F.sum(F.ln(c)), "n": F.count}, lambda p: F.exp(p["sum"] / F.nullif(p["n"], F.lit(0))))
aggregates.define("spread", {"high": F.max, "low": F.min}, lambda p: p["high"] - p["low"])


@query("""SELECT count(*) AS n, count(v) AS c, round(sum(v), 4) AS s, max(v) AS hi, min(v) AS lo, round(avg(v), 6) AS m, round(sum(v * v), 2) AS x2,
  round(stddev_pop(v), 6) AS sd, round(var_pop(v), 4) AS var FROM (SELECT nullif(value, 0) AS v FROM events)""")
def aggregate_names(t: Tables) -> DataFrame:
    pick = lambda n, a: {"name": n, "value": "v", "aggregate": a}
    rows = t.events.select(F.nullif("value", F.lit(0.0)).alias("v"))
    select = [{"name": "n", "value": ".", "aggregate": "one"}, pick("c", "X0"), pick("s", "add"), pick("hi", "maximum"), pick("lo", "minimum"), pick("m", "average"), pick("x2", "X2"), pick("sd", "stddev"), pick("var", "variance")]
    out = engine(t, rows=rows).run({"from": "rows", "select": select})
    return out.withColumns({"s": F.round("s", 4), "m": F.round("m", 6), "x2": F.round("x2", 2), "sd": F.round("sd", 6), "var": F.round("var", 4)})


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total, max(o_orderdate) AS latest FROM orders GROUP BY 1, 2""")
def aggregate_two_edges(t: Tables) -> DataFrame:
    select = [{"name": "n", "value": ".", "aggregate": "count"}, {"name": "total", "value": "o_totalprice", "aggregate": "sum"}, {"name": "latest", "value": "o_orderdate", "aggregate": "max"}]
    return engine(t, "orders").run({"from": "orders", "edges": ["o_orderstatus", "o_orderpriority"], "select": select}).withColumn("total", F.round("total", 2))


@query("""SELECT l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY ALL""")
def aggregate_many_edges(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) AS n FROM events WHERE event_type = 'click'""")
def count_only(t: Tables) -> DataFrame:
    return engine(t, "events").run({"from": "events", "select": [{"name": "n", "value": ".", "aggregate": "count"}], "where": {"term": {"event_type": "click"}}})


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2""")
def distinct_tuples(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT DISTINCT c_mktsegment, c_nationkey FROM customer""")
def select_distinct(t: Tables) -> DataFrame:
    return t.customer.select("c_mktsegment", "c_nationkey").distinct()


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 15""")
def having(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n > 15")


@query("""SELECT r_name, string_agg(n_name, ';' ORDER BY n_name) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def group_concat(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ";").alias("names"))


@query("""SELECT n, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1""")
def count_of_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("customers"))


@query("""SELECT year(o_orderdate) AS y, sum(CASE WHEN o_orderstatus = 'F' THEN 1 END)::BIGINT AS f, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS o FROM orders GROUP BY 1""")
def pivot_case(t: Tables) -> DataFrame:
    one = lambda s, e: F.sum(F.when(F.col("o_orderstatus") == s, 1).otherwise(e))
    return t.orders.groupBy(F.year("o_orderdate").alias("y")).agg(one("F", F.lit(None)).alias("f"), one("O", F.lit(0)).alias("o"))


@query("""SELECT user_id % 50 AS run, coalesce(max(CASE WHEN event_type = 'click' THEN value END), 0) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS view FROM events GROUP BY 1""")
def pivot_attributes(t: Tables) -> DataFrame:
    out = t.events.groupBy((F.col("user_id") % 50).alias("run")).pivot("event_type", ["click", "view"]).agg(F.max("value"))
    return out.withColumn("click", F.coalesce("click", F.lit(0.0)))


@query("""SELECT o_orderpriority AS p, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def pivot_discovered(t: Tables) -> DataFrame:
    """The pivot's columns are listed from the data and given to the plan; more values than a table should have columns are an error.
    Column ``p`` and the one of status P differ by case only, so the rows belong to a session that tells them apart."""
    t, most = Tables(case_sensitive(t.spark), t.folder), 1000
    values = [r[0] for r in t.orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"more than {most} values to pivot by")
    return t.orders.groupBy(F.col("o_orderpriority").alias("p")).pivot("o_orderstatus", values).agg(F.count(F.lit(1))).na.fill(0)


@query("""SELECT event_type, bool_and(v > 1) AS every, bool_or(v > 99) AS any_, count(v) AS n, max(v) AS hi, min(v) AS lo FROM
  (SELECT event_type, CASE WHEN event_id % 5 > 0 THEN value END AS v FROM events) GROUP BY 1""")
def folds(t: Tables) -> DataFrame:
    rows = t.events.select("event_type", F.when(F.col("event_id") % 5 > 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("x"))
    v = aggregates.known(F.col("x"))
    pick = lambda a, c: aggregates.aggregate(a, c)
    return rows.groupBy("event_type").agg(pick("and", v > 1).alias("every"), pick("or", v > 99).alias("any_"), pick("count", v).alias("n"), pick("max", v).alias("hi"), pick("min", v).alias("lo"))


@query("""SELECT o_orderstatus, list_sort(list(DISTINCT o_orderpriority)) AS all_, round(product(1 + o_custkey % 2 / 1000.0), 6) AS p FROM orders GROUP BY 1""")
def fold_union_product(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("x", 1 + F.col("o_custkey") % 2 / 1000.0)
    return rows.groupBy("o_orderstatus").agg(aggregates.aggregate("union", F.col("o_orderpriority")).alias("all_"), F.round(aggregates.aggregate("product", F.col("x")), 6).alias("p"))


@query("""SELECT event_type, n AS count, round(m, 6) AS mean, round(v, 4) AS variance, round(s3 / pow(v, 1.5), 5) AS skew, round(s4 / (v * v) - 3, 5) AS kurtosis FROM (
  SELECT event_type, count(*)::DOUBLE AS n, avg(value) AS m, var_pop(value) AS v,
    avg(value ** 3) - 3 * avg(value) * avg(value ** 2) + 2 * avg(value) ** 3 AS s3,
    avg(value ** 4) - 4 * avg(value) * avg(value ** 3) + 6 * avg(value) ** 2 * avg(value ** 2) - 3 * avg(value) ** 4 AS s4
  FROM events GROUP BY 1)""")
def moments(t: Tables) -> DataFrame:
    s = t.events.groupBy("event_type").agg(aggregates.power_sums(F.col("value")).alias("s"))
    s = s.select("event_type", aggregates.summary(F.col("s")).alias("m")).select("event_type", "m.*")
    return s.withColumns({"mean": F.round("mean", 6), "variance": F.round("variance", 4), "skew": F.round("skew", 5), "kurtosis": F.round("kurtosis", 5)})


@query("""SELECT event_type, count(*)::DOUBLE AS count, round(avg(value), 6) AS mean, round(var_pop(value), 4) AS variance FROM events WHERE user_id % 2 = 1 GROUP BY 1""")
def moments_subtracted(t: Tables) -> DataFrame:
    """Moments of odd users: those of all less those of even users, through the summaries and back."""
    sums = lambda df, n: df.groupBy("event_type").agg(aggregates.power_sums(F.col("value")).alias(n))
    whole = sums(t.events, "all").select("event_type", aggregates.summary(F.col("all")).alias("all"))
    both = whole.join(sums(t.events.filter("user_id % 2 = 0"), "even"), "event_type")
    left = aggregates.combine_sums(aggregates.unsummary(F.col("all")), F.col("even"), -1)
    return both.select("event_type", aggregates.summary(left).alias("m")).select("event_type", "m.count", F.round("m.mean", 6).alias("mean"), F.round("m.variance", 4).alias("variance"))


@query("""SELECT event_id, CASE WHEN a IS NULL AND b IS NULL THEN NULL ELSE coalesce(a, 0) + coalesce(b, 0) END AS total FROM
  (SELECT event_id, nullif(user_id % 3, 0) AS a, nullif(user_id % 2, 0) AS b FROM events)""")
def null_tolerant_sum(t: Tables) -> DataFrame:
    a, b = F.nullif(F.col("user_id") % 3, F.lit(0)), F.nullif(F.col("user_id") % 2, F.lit(0))
    return t.events.select("event_id", aggregates.null_add(a, b).alias("total"))


@query("""SELECT event_type, round(exp(avg(ln(value + 1))), 6) AS g, round(max(value) - min(value), 6) AS spread FROM events GROUP BY 1""")
def aggregate_own(t: Tables) -> DataFrame:
    select = [{"name": "g", "value": {"script": "value + 1"}, "aggregate": "geometric"}, {"name": "spread", "value": "value", "aggregate": "spread"}]
    return engine(t, "events").run({"from": "events", "edges": ["event_type"], "select": select}).withColumns({"g": F.round("g", 6), "spread": F.round("spread", 6)})


@query("""SELECT event_id, round(max(value) OVER w - min(value) OVER w, 6) AS spread FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def window_own(t: Tables) -> DataFrame:
    window = {"name": "spread", "value": "value", "aggregate": "spread", "edges": ["user_id", "event_type"], "sort": ["ts", "event_id"], "range": {"min": -5, "max": 1}}
    return engine(t, "events").run({"from": "events", "select": ["event_id", "spread"], "window": [window]}).withColumn("spread", F.round("spread", 6))


@query("""SELECT user_id, run, event_type, count(*) AS n FROM (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM
  (SELECT *, CASE WHEN lag(event_id) OVER w IS NULL OR event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 0 ELSE 1 END AS chg FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))
  GROUP BY ALL""")
def group_runs(t: Tables) -> DataFrame:
    r = groups.runs(t.events, ["event_type"], ["ts", "event_id"], ["user_id"])
    return r.groupBy("user_id", "run", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type, chunk, count(*) AS n, min(event_id) AS first FROM (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 100 AS chunk FROM events) GROUP BY 1, 2""")
def group_chunks(t: Tables) -> DataFrame:
    return groups.chunks(t.events, 100, ["event_id"], ["event_type"]).groupBy("event_type", "chunk").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@query("""SELECT chunk, count(*) AS n, max(event_id) AS last FROM (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 333 AS chunk FROM events) GROUP BY 1""")
def global_chunks(t: Tables) -> DataFrame:
    return groups.global_chunks(t.events, 333, "event_id").groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


@query("""SELECT c_nationkey, len(list(c_custkey)) AS n, list_sort(list(c_custkey))[1] AS first FROM customer GROUP BY 1""")
def group_rows(t: Tables) -> DataFrame:
    g = groups.group_rows(t.customer.select("c_nationkey", "c_custkey"), ["c_nationkey"], ["c_custkey"])
    return g.select("c_nationkey", F.size("rows").cast("long").alias("n"), F.get("rows", F.lit(0))["c_custkey"].alias("first"))


@query("""SELECT o_orderpriority AS v, sum(n)::BIGINT AS n FROM (SELECT o_orderpriority, 1 AS n FROM orders UNION ALL SELECT o_orderpriority, 1 FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def bag_add(t: Tables) -> DataFrame:
    a = groups.bag(t.orders.select(F.col("o_orderpriority").alias("v")), "v")
    return groups.bag_add(a, groups.bag(t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("v")), "v"), "v")


@query("""SELECT v, sum(n)::BIGINT AS n FROM (SELECT o_orderpriority AS v, 1 AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderpriority, -1 FROM orders WHERE o_orderstatus = 'O') GROUP BY 1 HAVING sum(n) <> 0""")
def bag_subtract(t: Tables) -> DataFrame:
    one = lambda s: groups.bag(t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_orderpriority").alias("v")), "v")
    return groups.bag_subtract(one("F"), one("O"), "v", negative=True)


@query("""WITH RECURSIVE c AS (SELECT c_nationkey, count(*) AS n, row_number() OVER (ORDER BY c_nationkey) AS i FROM customer GROUP BY 1),
  g(i, c_nationkey, grp, held) AS (SELECT i, c_nationkey, 0, n FROM c WHERE i = 1 UNION ALL
    SELECT c.i, c.c_nationkey, CASE WHEN held < 100 OR held + n < 200 THEN grp ELSE grp + 1 END, CASE WHEN held < 100 OR held + n < 200 THEN held + n ELSE n END FROM g JOIN c ON c.i = g.i + 1)
  SELECT grp, c_nationkey FROM g""")
def pack_groups(t: Tables) -> DataFrame:
    """Nations packed into groups of 100 to 200 customers; the greedy is sequential, over one count per nation."""
    counts = [(r["c_nationkey"], r["count"]) for r in t.customer.groupBy("c_nationkey").count().orderBy("c_nationkey").collect()]
    packed = groups.pack_groups(counts, 100, 200)
    return t.spark.createDataFrame([(i, k) for i, g in enumerate(packed) for k in g], "grp int, c_nationkey int")
