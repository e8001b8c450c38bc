"""Queries in the JSON language: scans, filters, projections, nested records, edges and domains, cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.dimensions import Dimension
from ..plans.paths import drill_filter
from ..plans.query import Engine
from .registry import Tables, query


def engine(t: Tables, *names: str, **more: DataFrame) -> Engine:
    return Engine(t.spark, {n: t[n] for n in names} | more)


def orders_with_items(t: Tables) -> DataFrame:
    """Orders with their items as an array; every seventh order has an empty array."""
    items = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("double").alias("quantity"), F.col("l_returnflag").alias("flag"))).alias("all"))
    some = F.when(F.col("o_orderkey") % 7 == 0, F.slice("all", 1, 0)).otherwise(F.col("all"))
    return t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("order"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("double").alias("price")).alias("head"), some.alias("items"))


NESTED = """(SELECT o_orderkey AS "order", o_orderstatus AS status, CAST(o_totalprice AS DOUBLE) AS price, l_linenumber AS line,
  CAST(l_quantity AS DOUBLE) AS quantity, l_returnflag AS flag
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND o_orderkey % 7 <> 0)"""


@query("""SELECT event_id, user_id, value FROM events WHERE event_type = 'click' AND value >= 10 ORDER BY value DESC NULLS LAST, event_id LIMIT 50""")
def scan_fields(t: Tables) -> DataFrame:
    return engine(t, "events").run({"from": "events", "select": ["event_id", "user_id", "value"], "where": {"and": [{"term": {"event_type": "click"}}, {"range": {"value": {"gte": 10}}}]}, "sort": [{"field": "value", "sort": -1}, "event_id"], "limit": 50})


@query("""SELECT event_id FROM events WHERE (event_type IN ('click', 'view') OR NOT (user_id % 3 = 1)) AND NOT (value > 20 AND value <= 60)""")
def filter_boolean(t: Tables) -> DataFrame:
    where = {"and": [{"or": [{"terms": {"event_type": ["click", "view"]}}, {"not": {"script": "pmod(user_id, 3) = 1"}}]}, {"not": {"range": {"value": {">": 20, "<=": 60}}}}, {"and": [{"match_all": {}}]}]}
    return engine(t, "events").run({"from": "events", "select": ["event_id"], "where": where})


@query("""SELECT event_id, v FROM (SELECT event_id, nullif(event_type, 'view') AS v FROM events)
  WHERE (v IS NULL OR v = 'click') AND NOT (v IS NOT NULL AND v = 'purchase')""")
def filter_missing_values(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.nullif("event_type", F.lit("view")).alias("v"))
    where = {"and": [{"terms": {"v": ["click", None]}}, {"not": {"term": {"v": "purchase"}}}, {"or": [{"missing": "v"}, {"exists": {"field": "v"}}]}]}
    return engine(t, rows=rows).run({"from": "rows", "select": ["event_id", "v"], "where": where})


@query("""SELECT p_partkey, p_name FROM part WHERE starts_with(p_brand, 'Brand#1') AND contains(p_name, 'e') AND p_size BETWEEN 5 AND 30""")
def filter_text(t: Tables) -> DataFrame:
    where = {"and": [{"prefix": {"p_brand": "Brand#1"}}, {"instr": {"p_name": "e"}}, {"range": {"p_size": {"from": 5, "to": 30}}}]}
    return engine(t, "part").run({"from": "part", "select": ["p_partkey", "p_name"], "where": where})


@query("""SELECT "order" AS number, status AS head_status, price / 2 AS half FROM (SELECT DISTINCT "order", status, price FROM """ + NESTED + """)""")
def select_renamed_paths(t: Tables) -> DataFrame:
    q = {"from": "o", "select": [{"name": "number", "value": "order"}, {"name": "head_status", "value": "head.status"}, {"name": "half", "value": {"script": "head.price / 2"}}]}
    return engine(t, o=orders_with_items(t)).run(q)


@query(f"""SELECT quantity FROM {NESTED} WHERE line IS NOT NULL UNION ALL SELECT NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def select_one_nested_path(t: Tables) -> DataFrame:
    return engine(t, o=orders_with_items(t)).run({"from": "o", "select": "items.quantity"})


@query(f"""SELECT "order", status, line, quantity FROM {NESTED}""")
def select_nested_with_parents(t: Tables) -> DataFrame:
    return engine(t, o=orders_with_items(t)).run({"from": "o", "select": ["order", "head.status", "items.line", "items.quantity"]})


@query(f"""SELECT "order", line, quantity FROM {NESTED} WHERE status = 'O' AND quantity > 25 AND flag = 'N'""")
def filter_nested(t: Tables) -> DataFrame:
    where = {"and": [{"term": {"head.status": "O"}}, {"range": {"items.quantity": {"gt": 25}}}, {"term": {"items.flag": "N"}}]}
    flat = drill_filter(orders_with_items(t), where)
    return flat.df.select(flat.col("order").alias("order"), flat.col("items.line").alias("line"), flat.col("items.quantity").alias("quantity"))


@query(f"""SELECT DISTINCT "order" FROM {NESTED} WHERE quantity >= 49""")
def filter_any_child(t: Tables) -> DataFrame:
    return engine(t, o=orders_with_items(t)).run({"from": "o", "select": ["order"], "where": {"nested": {"path": "items", "query": {"range": {"items.quantity": {"gte": 49}}}}}})


@query(f"""SELECT status, flag, count(*) AS n, sum(quantity) AS total FROM {NESTED} GROUP BY status, flag""")
def aggregate_nested(t: Tables) -> DataFrame:
    q = {"from": "o", "edges": ["head.status", "items.flag"], "select": [{"name": "n", "aggregate": "count", "value": "."}, {"name": "total", "value": "items.quantity", "aggregate": "sum"}]}
    return engine(t, o=orders_with_items(t)).run(q)


@query("""SELECT o_orderkey, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_totalprice > 100000""")
def select_records(t: Tables) -> DataFrame:
    out = engine(t, "orders").run({"from": "orders", "select": ["o_orderkey", {"name": "pair", "value": {"c": "o_custkey", "s": "o_orderstatus"}}], "where": {"range": {"o_totalprice": {"gt": 100000}}}})
    return out.select("o_orderkey", "pair.c", "pair.s")


@query("""SELECT event_type, count(*) AS n, round(avg(v), 6) AS m FROM (SELECT event_type, value * 2 AS v FROM events WHERE value > 5) GROUP BY event_type""")
def query_of_query(t: Tables) -> DataFrame:
    inner = {"from": "events", "select": ["event_type", {"name": "v", "value": {"script": "value * 2"}}], "where": {"range": {"value": {"gt": 5}}}}
    out = engine(t, "events").run({"from": inner, "edges": ["event_type"], "select": [{"name": "n", "value": ".", "aggregate": "count"}, {"name": "m", "value": "v", "aggregate": "mean"}]})
    return out.withColumn("m", F.round("m", 6))


@query("""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority END AS p, count(*) AS n FROM orders GROUP BY 1""")
def edge_set(t: Tables) -> DataFrame:
    return engine(t, "orders").run({"from": "orders", "edges": [{"name": "p", "value": "o_orderpriority", "domain": {"type": "set", "partitions": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'middle' END AS size, count(*) AS n FROM events GROUP BY 1""")
def edge_predicates(t: Tables) -> DataFrame:
    parts = [{"name": "low", "esfilter": {"range": {"value": {"lt": 10}}}}, {"name": "middle", "esfilter": {"range": {"value": {"lt": 100}}}}]
    return engine(t, "events").run({"from": "events", "edges": [{"name": "size", "domain": {"type": "set", "partitions": parts}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT part, count(*) AS n FROM (SELECT unnest(['small', 'odd', NULL]) AS part, value, event_id FROM events) WHERE
  (part = 'small' AND value < 20) OR (part = 'odd' AND event_id % 2 = 1) OR (part IS NULL AND NOT (value < 20) AND NOT (event_id % 2 = 1)) GROUP BY part""")
def edge_facets(t: Tables) -> DataFrame:
    parts = [{"name": "small", "esfilter": {"range": {"value": {"lt": 20}}}}, {"name": "odd", "esfilter": {"script": "mod(event_id, 2) = 1"}}]
    return engine(t, "events").run({"from": "events", "edges": [{"name": "part", "domain": {"type": "set", "isFacet": True, "partitions": parts}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT CASE WHEN value >= 0 AND value < 50 THEN floor(value / 5) * 5 END AS bucket, count(*) AS n FROM events GROUP BY 1""")
def edge_numeric(t: Tables) -> DataFrame:
    return engine(t, "events").run({"from": "events", "edges": [{"name": "bucket", "value": "value", "domain": {"type": "numeric", "min": 0, "max": 50, "interval": 5}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(*) AS n FROM orders GROUP BY 1""")
def edge_month(t: Tables) -> DataFrame:
    return engine(t, "orders").run({"from": "orders", "edges": [{"name": "month", "value": "o_orderdate", "domain": {"type": "time", "interval": "month"}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') AS at, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def edge_time(t: Tables) -> DataFrame:
    return engine(t, "events").run({"from": "events", "edges": [{"name": "at", "value": "ts", "domain": {"type": "time", "interval": "6hour"}}, "event_type"], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT CASE WHEN d < 90 * 86400000.0 THEN floor(d / 604800000.0) * 604800000.0 END AS age, count(*) AS n
  FROM (SELECT epoch_ms(l_shipdate::TIMESTAMP) - epoch_ms(o_orderdate::TIMESTAMP) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE d >= 0 GROUP BY 1""")
def edge_duration(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select((F.unix_millis(F.col("l_shipdate").cast("timestamp")) - F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("d")).filter("d >= 0")
    return engine(t, rows=rows).run({"from": "rows", "edges": [{"name": "age", "value": "d", "domain": {"type": "duration", "min": 0, "max": "90day", "interval": "week"}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})


@query("""SELECT o_orderstatus AS s, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2""")
def edge_composite(t: Tables) -> DataFrame:
    out = engine(t, "orders").run({"from": "orders", "edges": [{"name": "key", "value": {"s": "o_orderstatus", "p": "o_orderpriority"}}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})
    return out.select("key.s", "key.p", "n")


@query("""SELECT s, p, n FROM (SELECT * FROM (VALUES ('F'), ('O'), ('X'), (NULL)) a(s) CROSS JOIN (VALUES ('1-URGENT'), ('2-HIGH'), (NULL)) b(p)) g LEFT JOIN
  (SELECT CASE WHEN o_orderstatus IN ('F', 'O', 'X') THEN o_orderstatus END AS s2, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority END AS p2, count(*) AS n FROM orders GROUP BY 1, 2) c
  ON s IS NOT DISTINCT FROM s2 AND p IS NOT DISTINCT FROM p2""")
def cube_dense(t: Tables) -> DataFrame:
    edges = [{"name": "s", "value": "o_orderstatus", "domain": {"type": "set", "partitions": ["F", "O", "X"]}}, {"name": "p", "value": "o_orderpriority", "domain": {"type": "set", "partitions": ["1-URGENT", "2-HIGH"]}}]
    return engine(t, "orders").cube({"from": "orders", "edges": edges, "select": [{"name": "n", "value": ".", "aggregate": "count"}]}).dense()


@query("""SELECT o_orderstatus AS s, max(n) AS n FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def cube_reduce(t: Tables) -> DataFrame:
    cube = engine(t, "orders").cube({"from": "orders", "edges": [{"name": "s", "value": "o_orderstatus"}, {"name": "p", "value": "o_orderpriority"}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})
    return cube.reduce("n", "max", ("s",))


@query("""SELECT o_orderpriority AS p, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def cube_slice(t: Tables) -> DataFrame:
    cube = engine(t, "orders").cube({"from": "orders", "edges": [{"name": "s", "value": "o_orderstatus"}, {"name": "p", "value": "o_orderpriority"}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})
    return cube.slice(s="F").select(orders="n").df


@query("""SELECT s, len(list(p)) AS parts, sum(n)::BIGINT AS total FROM (SELECT o_orderstatus AS s, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY s""")
def cube_groupby(t: Tables) -> DataFrame:
    cube = engine(t, "orders").cube({"from": "orders", "edges": [{"name": "s", "value": "o_orderstatus"}, {"name": "p", "value": "o_orderpriority"}], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})
    return cube.groupby("s").select("s", F.size("cells").cast("long").alias("parts"), F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("total"))


DIMS = {"name": ".", "edges": [{"name": "Order", "edges": [{"name": "State", "field": "o_orderstatus"}, {"name": "Key", "field": ["o_orderstatus", "o_orderpriority"]}, {"name": "Rush", "partitions": [{"name": "rush", "esfilter": {"terms": {"o_orderpriority": ["1-URGENT", "2-HIGH"]}}}, {"name": "calm", "esfilter": {"term": {"o_orderpriority": "5-LOW"}}}]}]}]}


@query("""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' WHEN o_orderpriority = '5-LOW' THEN 'calm' END AS "Rush", count(*) AS n
  FROM orders WHERE o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority = '5-LOW') GROUP BY 1""")
def dimension_names(t: Tables) -> DataFrame:
    e = Engine(t.spark, {"orders": t.orders}, DIMS)
    where = {"or": [{"term": {"Order.State": "O"}}, {"term": {"Order.Key": ["F", "5-LOW"]}}]}
    return e.run({"from": "orders", "edges": [{"name": "Rush", "value": "Order.Rush"}], "select": [{"name": "n", "value": ".", "aggregate": "count"}], "where": where})


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS count, grouping_id(o_orderstatus, o_orderpriority) AS level FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""")
def dimension_members(t: Tables) -> DataFrame:
    return Dimension.parse(DIMS).find("Order.Key").members(t.orders)


@query("""SELECT day, count(c) AS n FROM (SELECT unnest(range(TIMESTAMP '1995-01-01', TIMESTAMP '1995-03-01', INTERVAL 7 DAY)) AS day) d LEFT JOIN
  (SELECT l_orderkey AS c, o_orderdate::TIMESTAMP AS a, CASE WHEN l_linenumber < 6 THEN l_shipdate::TIMESTAMP END AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey) r
  ON a <= day AND (b IS NULL OR b >= day) GROUP BY day""")
def edge_snapshot(t: Tables) -> DataFrame:
    return _range_edge(t, "snapshot")


@query("""SELECT day, count(c) AS n FROM (SELECT unnest(range(TIMESTAMP '1995-01-01', TIMESTAMP '1995-03-01', INTERVAL 7 DAY)) AS day) d LEFT JOIN
  (SELECT l_orderkey AS c, o_orderdate::TIMESTAMP AS a, CASE WHEN l_linenumber < 6 THEN l_shipdate::TIMESTAMP END AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey) r
  ON a < day + INTERVAL 7 DAY AND (b IS NULL OR b > day) GROUP BY day""")
def edge_inclusive(t: Tables) -> DataFrame:
    return _range_edge(t, "inclusive")


def _range_edge(t: Tables, mode: str) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_orderdate").cast("timestamp").alias("a"), F.when(F.col("l_linenumber") < 6, F.col("l_shipdate").cast("timestamp")).alias("b"))
    edge = {"name": "day", "allowNulls": False, "range": {"min": "a", "max": "b", "mode": mode}, "domain": {"type": "time", "min": "1995-01-01", "max": "1995-03-01", "interval": "week"}}
    return engine(t, rows=rows).run({"from": "rows", "edges": [edge], "select": [{"name": "n", "value": ".", "aggregate": "count"}]})
