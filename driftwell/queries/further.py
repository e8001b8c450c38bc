"""Text layout, zones and calendars, binary numbers, files and their readers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import conversions, jsons, maths, strings, times
from ..operators import windows
from ..sources import scans, sinks
from .pipelines import scratch
from .registry import Tables, query


@query("""SELECT n_nationkey, chr(9) || '  ' || n_name || chr(10) || chr(10) || chr(9) || '    x' AS inside, n_name || chr(10) || chr(10) || '  x' AS outside, n_name AS text,
  '{"k":' || n_regionkey || '}' AS record, '' AS missing FROM nation""")
def strings_layout(t: Tables) -> DataFrame:
    block = F.concat(F.lit("  "), F.col("n_name"), F.lit("\n\n    x"))
    return t.nation.select(
        "n_nationkey", strings.indent(block).alias("inside"), strings.outdent(block).alias("outside"), strings.to_string(F.col("n_name")).alias("text"),
        strings.to_string(F.struct(F.col("n_regionkey").alias("k")), "container").alias("record"), strings.to_string(F.lit(None).cast("int")).alias("missing"),
    )


@query("""SELECT event_id, moment >= TIMESTAMP '2024-03-10 07:00:00' AND moment < TIMESTAMP '2024-11-03 06:00:00' AS dst, moment - INTERVAL 1 HOUR * (CASE WHEN moment >= TIMESTAMP '2024-03-10 07:00:00' AND moment < TIMESTAMP '2024-11-03 06:00:00' THEN 4 ELSE 5 END) AS eastern,
  CASE WHEN NOT (moment >= TIMESTAMP '2024-11-03 05:00:00' AND moment < TIMESTAMP '2024-11-03 07:00:00') THEN moment END AS back
  FROM (SELECT event_id, ts + INTERVAL 1 MONTH * (user_id % 12) AS moment FROM events)""")
def times_zones(t: Tables) -> DataFrame:
    """The two hours that a clock shows twice have no way back: null."""
    at = F.col("at")
    rows = t.events.select("event_id", F.timestamp_add("MONTH", (F.col("user_id") % 12).cast("int"), F.col("ts").cast("timestamp")).alias("at"))
    twice = (at >= F.lit("2024-11-03 05:00:00").cast("timestamp")) & (at < F.lit("2024-11-03 07:00:00").cast("timestamp"))
    eastern = times.from_gmt(at, "E")
    return rows.select("event_id", times.is_dst(at).alias("dst"), eastern.alias("eastern"), F.when(~twice, times.to_gmt(eastern, "E")).alias("back"))


@query("""SELECT event_id, CASE WHEN age < 7 THEN 7 WHEN age < 30 THEN 30 WHEN age < 60 THEN 60 WHEN age < 90 THEN 90 END AS horizon, day(last_day(ts)) AS days, strftime(ts, '%Y%m') AS month, date_trunc('second', ts)::TIMESTAMP AS second
  FROM (SELECT event_id, ts, (epoch_us(TIMESTAMP '2024-04-10') - epoch_us(ts)) / 86400000000.0 AS age FROM events)""")
def times_horizon(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id", times.horizon(ts, F.lit("2024-04-10").cast("timestamp")).alias("horizon"), times.days_in_month(ts).alias("days"),
        times.month_name(F.unix_millis(ts)).alias("month"), times.to_timestamp(F.unix_seconds(ts)).alias("second"),
    )


@query("""SELECT tod, minute, count(event_id) AS n FROM (SELECT printf('%02d:%02d', i // 60, i % 60) AS tod, i::INT AS minute FROM range(0, 1440, 30) r(i)) LEFT JOIN events ON hour(ts) * 60 + minute(ts) // 30 * 30 = minute GROUP BY 1, 2""")
def times_of_day(t: Tables) -> DataFrame:
    """Events by half hour of the day, joined to the table of times."""
    at = t.events.select("event_id", (F.hour("ts") * 60 + F.floor(F.minute("ts") / 30).cast("int") * 30).alias("minute"))
    counts = at.groupBy("minute").agg(F.count("event_id").alias("n"))
    return times.times_of_day(t.spark, 30).join(counts, "minute", "left").select("tod", "minute", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""SELECT name, count(event_id) AS n FROM (VALUES ('today', DATE '2024-01-17', DATE '2024-01-18'), ('yesterday', DATE '2024-01-16', DATE '2024-01-17'), ('this week', DATE '2024-01-14', DATE '2024-01-21'),
  ('last week', DATE '2024-01-07', DATE '2024-01-14'), ('this month', DATE '2024-01-01', DATE '2024-02-01'), ('last month', DATE '2023-12-01', DATE '2024-01-01')) v(name, low, high)
  LEFT JOIN events ON ts >= low AND ts < high GROUP BY 1""")
def times_relative(t: Tables) -> DataFrame:
    """Events in the periods that reports offer, seen from a Wednesday."""
    names = ["today", "yesterday", "this week", "last week", "this month", "last month"]
    periods = times.relative_ranges(t.spark, dt.date(2024, 1, 17)).filter(F.col("name").isin(names))
    inside = (F.col("ts") >= F.col("min").cast("timestamp")) & (F.col("ts") < F.col("max").cast("timestamp"))
    # The six periods go to the events, and six counts come back to the periods.
    counts = t.events.select("event_id", "ts").join(F.broadcast(periods), inside).groupBy("name").agg(F.count("event_id").alias("n"))
    return periods.select("name").join(counts, "name", "left").select("name", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("""SELECT c_custkey, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS hash, CASE WHEN b >= 128 THEN b - 256 ELSE b END AS byte, [c_mktsegment] AS list, len(list) AS size
  FROM (SELECT c_custkey, c_mktsegment, ('0x' || substr(md5(c_name), 1, 8))::BIGINT AS h, c_custkey % 256 AS b, [c_mktsegment] AS list FROM customer)""")
def conversions_binary(t: Tables) -> DataFrame:
    one = conversions.as_list(F.col("c_mktsegment"), False)
    byte = F.unhex(conversions.hex_of(F.col("c_custkey") % 256, 2))
    return t.customer.select("c_custkey", conversions.text_hash(F.col("c_name"), 8).alias("hash"), conversions.binary_number(byte, 8).alias("byte"), one.alias("list"), F.size(one).alias("size"))


@query("""SELECT n_regionkey % 2 AS k, count(DISTINCT n_regionkey) AS kinds, count(*) AS n FROM nation GROUP BY 1""")
def conversions_hash(t: Tables) -> DataFrame:
    """Equal records have equal hashes and equal text, whatever the order of their columns."""
    rows = t.nation.select((F.col("n_regionkey") % 2).alias("k"), F.col("n_regionkey").alias("b"), F.lit("x").alias("a"))
    both = rows.withColumn("h", conversions.structural_hash("a", "b")).withColumn("s", jsons.encode(rows, ["b", "a"]))
    return both.groupBy("k").agg(F.count_distinct("h", "s").alias("kinds"), F.count("*").alias("n"))


@query("""SELECT event_id, abs(value - 50) AS size, sign(value - 50)::DOUBLE AS sign, printf('%.1f%%', (user_id % 100) * 12.5) AS share, floor(value / 2.5) * 2.5 AS low, abs(value - round(value, 1)) <= greatest(abs(value), abs(round(value, 1))) * 0.001 AS near
  FROM events WHERE value IS NOT NULL""")
def maths_closeness(t: Tables) -> DataFrame:
    v = F.col("value").cast("double")
    return t.events.filter("value is not null").select(
        "event_id", F.abs(v - 50).alias("size"), F.signum(v - 50).alias("sign"), maths.percent((F.col("user_id") % 100) / 8, 1).alias("share"),
        maths.floor_interval(v, 2.5).cast("double").alias("low"), maths.close_enough(v, F.round(v, 1), 0.001).alias("near"),
    )


@query("""SELECT event_id, bool_or(nullif(event_type, 'click') IS NOT NULL) OVER w AS some, bool_or(value > 90) OVER w AS high, bool_and(value > 1) OVER w AS positive FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def window_exists(t: Tables) -> DataFrame:
    spec = windows.ordered([F.col("user_id")], [F.col("ts"), F.col("event_id")]).rowsBetween(-2, 0)
    kind = F.nullif(F.col("event_type"), F.lit("click"))
    return t.events.select("event_id", windows.over("exists", kind, spec).alias("some"), windows.over("or", F.col("value") > 90, spec).alias("high"), windows.over("and", F.col("value") > 1, spec).alias("positive"))


@query("""SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation""")
def scan_json_lines(t: Tables) -> DataFrame:
    path = scratch(t)
    sinks.write_text(t.nation.select(F.format_string("{id: %d, /* its name */ \"name\": \"%s\", region: %d}", "n_nationkey", "n_name", "n_regionkey").alias("value")), path)
    return scans.json_lines(t.spark, path, "id int, name string, region int").select(F.col("id").alias("id"), "name", "region")


@query("""SELECT to_timestamp(o_orderkey)::TIMESTAMP AS date, 'n' || o_orderkey AS node, o_custkey::INT AS revision, 'A B ' || o_orderstatus AS author, o_orderpriority || ' +' AS description, 2 AS files, 0 AS tags FROM orders""")
def scan_change_log(t: Tables) -> DataFrame:
    path, key = scratch(t), F.col("o_orderkey")
    text = [F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")) for c in (F.concat(F.lit("A B "), F.col("o_orderstatus")), F.concat(F.col("o_orderpriority"), F.lit(" +")))]
    sinks.write_text(t.orders.select(F.concat_ws("\t", key.cast("string"), F.concat(F.lit("n"), key), F.col("o_custkey").cast("string"), text[0], F.lit("a.c b.h"), F.lit(" "), text[1]).alias("value")), path)
    return scans.change_log(t.spark, path).select("date", "node", "revision", "author", "description", F.size("files").alias("files"), F.greatest(F.size("tags"), F.lit(0)).alias("tags"))


@query("""SELECT n_regionkey::VARCHAR AS region, count(*) AS lines, sum(length(n_name) + 1) AS bytes FROM nation GROUP BY 1""")
def sink_blobs(t: Tables) -> DataFrame:
    """A folder for each region with the names as text, read back as lines and as files."""
    path = scratch(t)
    sinks.write_blobs(t.nation.select(F.col("n_regionkey").cast("string").alias("region"), "n_name"), "region", "n_name", path)
    region = F.regexp_extract("path", r"region=(\w+)", 1).alias("region")
    files = scans.folder(t.spark, f"{path}/*", "*.txt").groupBy(region).agg(F.sum("length").alias("bytes"))
    lines = scans.lines(t.spark, path).groupBy(F.col("region").cast("string").alias("region")).agg(F.count("*").alias("lines"))
    return lines.join(files, "region")
