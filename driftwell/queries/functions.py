"""Scalar functions, one query a family."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import conversions, jsons, maths, stats, strings, times
from ..operators.aggregates import power_sums, summary
from ..operators.selection import medians
from .registry import Tables, query


@query("""SELECT p_partkey, regexp_extract(p_type, '^[^ ]+') AS word, len(string_split(p_name, ' ')) AS words, upper(p_brand) AS up, lower(p_brand) AS low, replace(p_brand, '#', '-') AS dashed,
  regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g') AS plain, CASE WHEN contains(p_brand, '#') AND contains(substr(p_brand, instr(p_brand, '#') + 1), '3') THEN split_part(split_part(p_brand, '#', 2), '3', 1) END AS inner_,
  left(p_name, length(p_name) - 2) AS cut, substr(p_name, 4) AS tail, CASE WHEN instr(p_name, 'zz') = 0 THEN length(p_name) + 1 ELSE instr(p_name, 'zz') END AS at FROM part""")
def strings_words(t: Tables) -> DataFrame:
    p, b = F.col("p_name"), F.col("p_brand")
    return t.part.select(
        "p_partkey", strings.get_word(F.col("p_type"), " ", 0).alias("word"), strings.word_count(p, " ").alias("words"), F.upper(b).alias("up"), F.lower(b).alias("low"),
        F.replace(b, F.lit("#"), F.lit("-")).alias("dashed"), strings.deformat(b).alias("plain"), strings.between(b, "#", "3").alias("inner_"), strings.left_but(p, 2).alias("cut"),
        strings.right_but(p, 3).alias("tail"), strings.locate_or_end("zz", p).alias("at"),
    )


@query("""SELECT a.p_partkey AS x, b.p_partkey AS y, round(levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name))::DOUBLE, 9) AS d FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def strings_distance(t: Tables) -> DataFrame:
    a, b = t.part.alias("a"), t.part.alias("b")
    d = strings.edit_distance(F.col("a.p_name"), F.col("b.p_name"))
    return a.join(b, F.col("b.p_partkey") == F.col("a.p_partkey") + 1).select(F.col("a.p_partkey").alias("x"), F.col("b.p_partkey").alias("y"), F.round(d, 9).alias("d"))


@query("""SELECT doc_id, regexp_replace(text, '[\\x00-\\x1f]', ' ', 'g') AS flat, regexp_replace(regexp_replace(text, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '') AS bare,
  coalesce(least(nullif(instr(text, 'the'), 0), nullif(instr(text, 'que'), 0)), 0) - 1 AS first FROM documents""")
def strings_clean(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.select("doc_id", strings.remove_control(x).alias("flat"), strings.trim_all(x).alias("bare"), strings.find_first(x, ["the", "que"]).alias("first"))


@query("""SELECT * FROM (VALUES ('12', true, true), ('-1.5e3', true, false), ('x1', false, false), (NULL, false, false), ('.5', true, false)) v(s, number, digits)""")
def strings_numeric(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([("12",), ("-1.5e3",), ("x1",), (None,), (".5",)], "s string")
    return rows.select("s", strings.is_numeric(F.col("s")).alias("number"), strings.is_digits(F.col("s")).alias("digits"))


@query("""SELECT n_nationkey, '|' || n_name || '||' || n_regionkey || '|' AS piped, ' size=' || n_nationkey AS flag, '"' || n_name || '"' AS quoted, '''' || n_name || '''' AS sql, n_name || chr(9) || n_regionkey AS tab FROM nation""")
def strings_quoting(t: Tables) -> DataFrame:
    n, k = F.col("n_name"), F.col("n_regionkey").cast("string")
    return t.nation.select(
        "n_nationkey", strings.piped(F.array(n, k)).alias("piped"), strings.flag("size=", F.col("n_nationkey")).alias("flag"), strings.quote(n).alias("quoted"),
        strings.sql_literal(n, "text").alias("sql"), strings.csv_to_tab(F.concat_ws(",", n, k), 2).alias("tab"),
    )


@query("""SELECT n_nationkey, hex(encode(n_name)) AS hex_, to_base64(encode(n_name)) AS b64, url_encode(n_name || ' &') AS url, md5(n_name) AS digest, ascii(n_name) AS first, n_name AS back FROM nation""")
def strings_encodings(t: Tables) -> DataFrame:
    n = F.col("n_name")
    return t.nation.select(
        "n_nationkey", F.hex(n).alias("hex_"), F.base64(F.encode(n, "utf-8")).alias("b64"), F.replace(F.url_encode(F.concat(n, F.lit(" &"))), F.lit("+"), F.lit("%20")).alias("url"), F.md5(n).alias("digest"),
        F.ascii(n).alias("first"), conversions.decrypt(conversions.encrypt(n, b"0123456789abcdef0123456789abcdef"), b"0123456789abcdef0123456789abcdef").alias("back"),
    )


@query("""SELECT event_id, round(p * q / (p * q + (1 - p) * (1 - q)), 9) AS added, round(p * (1 - q) / (p * (1 - q) + (1 - p) * q), 9) AS less, floor(value / 5) * 5 AS low, ceil(value / 5) * 5 AS high, (user_id - 50) - 7 * floor((user_id - 50) / 7.0)::BIGINT AS m,
  greatest(p, q) AS hi, least(p, q) AS lo, (p <> 0 AND (p / q < 0.8 OR p / q > 1.2)) OR NOT (p * (1 - q) / (p * (1 - q) + (1 - p) * q) BETWEEN 0.3 AND 0.7) AS moved
  FROM (SELECT *, (user_id % 9 + 1) / 10.0 AS p, (event_id % 9 + 1) / 10.0 AS q FROM (SELECT event_id, user_id, value FROM events))""")
def maths_evidence(t: Tables) -> DataFrame:
    p, q, v = (F.col("user_id") % 9 + 1) / 10.0, (F.col("event_id") % 9 + 1) / 10.0, F.col("value")
    return t.events.select(
        "event_id", F.round(maths.bayesian_add(p, q), 9).alias("added"), F.round(maths.bayesian_subtract(p, q), 9).alias("less"), maths.floor_to(v, 5).alias("low"), maths.ceiling_to(v, 5).alias("high"),
        maths.mod(F.col("user_id") - 50, 7).alias("m"), F.greatest(p, q).alias("hi"), F.least(p, q).alias("lo"), maths.significant_difference(p, q).alias("moved"),
    )


@query("""SELECT user_id, round(1 / (1 + exp(-sum(ln(p / (1 - p))))), 9) AS p, round(-log10(1 - least(s, 0.999999) * 0.7 / (least(s, 0.999999) * 0.7 + (1 - least(s, 0.999999)) * 0.3)), 6) AS score FROM
  (SELECT user_id, (event_id % 9 + 1) / 10.0 AS p, 1 - 1.0 / (user_id + 2) AS s FROM events) GROUP BY user_id, s""")
def maths_scores(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", ((F.col("event_id") % 9 + 1) / 10.0).alias("p"), (1 - 1.0 / (F.col("user_id") + 2)).alias("s"))
    return rows.groupBy("user_id", "s").agg(maths.bayesian_sum(F.col("p")).alias("p")).select("user_id", F.round("p", 9).alias("p"), F.round(maths.alert_score(F.lit(0.7), F.col("s")), 6).alias("score"))


@query("""SELECT event_id, CASE WHEN value = 0 THEN 0.0 ELSE round(value / m) * m END AS two_digits, round(value * 10)::BIGINT::VARCHAR || '%' AS share, value = round(value) AS whole, coalesce(nullif(user_id, 0), -1) AS id FROM
  (SELECT *, 10.0 ** (ceil(log10(abs(value))) - 2) AS m FROM events WHERE value > 0)""")
def maths_rounding(t: Tables) -> DataFrame:
    v = F.col("value")
    some = t.events.filter("value > 0")
    share = F.concat(F.round(v * 10).cast("long").cast("string"), F.lit("%"))
    return some.select("event_id", maths.significant_digits(v, 2).alias("two_digits"), share.alias("share"), maths.is_integer(v).alias("whole"), F.coalesce(maths.zero_to_null(F.col("user_id")), F.lit(-1)).alias("id"))


@query("""SELECT user_id, median(value) AS m, count(*) AS n FROM events GROUP BY 1""")
def stats_median(t: Tables) -> DataFrame:
    return medians(t.events, ["user_id"], F.col("value")).select("user_id", stats.median_of_group().alias("m"), "n")


@query("""SELECT event_type AS name, round(sum(CASE WHEN value < 50 THEN 1.0 WHEN value = 50 THEN 0.5 ELSE 0 END)::DOUBLE, 3) AS below, round(count(value) - sum(least(1, greatest(0, 50 - value + 0.5))), 3) AS above_ FROM events GROUP BY 1""")
def stats_partition(t: Tables) -> DataFrame:
    """Values around 50: equal ones half and half, and split in proportion within half a unit."""
    around = lambda resolution: stats.counts_around(F.col("value"), F.lit(50.0), resolution)
    v = t.events.groupBy(F.col("event_type").alias("name")).agg(around(0)["below"].alias("b"), around(1.0)["above"].alias("a"))
    return v.select("name", F.round("b", 3).alias("below"), F.round("a", 3).alias("above_"))


#: Per user the interpolated median of values in steps of 20: the SQL of both queries below. ``{w}``: how much the neighbours of a single middle count.
INTERPOLATED = """(SELECT user_id, CASE WHEN n % 2 = 0 AND s[n // 2] <> mid THEN (s[n // 2] + mid) / 2 WHEN run > 1 THEN mid + (n / 2.0 - below) / run - 0.5
    WHEN n % 2 = 1 AND n > 1 THEN mid * (1 - {w}) + (s[n // 2] + s[n // 2 + 2]) / 2 * {w} ELSE mid END AS med
  FROM (SELECT *, len(list_filter(s, lambda x: x < mid)) AS below, len(list_filter(s, lambda x: x = mid)) AS run FROM
    (SELECT *, s[n // 2 + 1] AS mid FROM (SELECT user_id, list_sort(list(floor(value / 20))) AS s, count(*) AS n FROM events GROUP BY 1))))"""


@query(f"""SELECT user_id, round(med, 6) AS med FROM {INTERPOLATED.format(w=0.25)}""")
def stats_median_interpolated(t: Tables) -> DataFrame:
    v = medians(t.events, ["user_id"], F.floor(F.col("value") / 20))
    return v.select("user_id", F.round(stats.median_of_group(simple=False, mean_weight=0.25), 6).alias("med"))


@query(f"""SELECT user_id, CASE WHEN na < 3 OR nb < 3 THEN 0 ELSE round((pa - na / 2) ** 2 * 2 / (na / 2) + (pb - nb / 2) ** 2 * 2 / (nb / 2), 6) END AS chi2 FROM
  (SELECT user_id, coalesce(sum(share) FILTER (side), 0) AS pa, coalesce(sum(share) FILTER (NOT side), 0) AS pb, count(*) FILTER (side)::DOUBLE AS na, count(*) FILTER (NOT side)::DOUBLE AS nb FROM
    (SELECT user_id, event_id % 2 = 0 AS side, least(1, greatest(0, med - floor(value / 20) + 0.5)) AS share FROM events JOIN {INTERPOLATED.format(w=0.5)} m USING (user_id)) GROUP BY 1)""")
def stats_median_test_interpolated(t: Tables) -> DataFrame:
    both = stats.median_test_of_groups(t.events, ["user_id"], F.floor(F.col("value") / 20), F.col("event_id") % 2 == 0)
    return both.select("user_id", F.round("statistic", 6).alias("chi2"))


@query("""SELECT a.user_id AS x, round((pa - na / 2) ** 2 * 2 / (na / 2) + (pb - nb / 2) ** 2 * 2 / (nb / 2), 6) AS chi2 FROM
  (SELECT user_id, sum(CASE WHEN side AND value < med THEN 1.0 WHEN side AND value = med THEN 0.5 ELSE 0 END) AS pa, sum(CASE WHEN NOT side AND value < med THEN 1.0 WHEN NOT side AND value = med THEN 0.5 ELSE 0 END) AS pb,
    count(*) FILTER (side)::DOUBLE AS na, count(*) FILTER (NOT side)::DOUBLE AS nb FROM (SELECT user_id, event_id % 2 = 0 AS side, value, median(value) OVER (PARTITION BY user_id) AS med FROM events) GROUP BY 1) a WHERE na >= 3 AND nb >= 3""")
def stats_median_test(t: Tables) -> DataFrame:
    both = stats.median_test_of_groups(t.events, ["user_id"], F.col("value"), F.col("event_id") % 2 == 0, interpolate=False)
    return both.filter("a.below + a.above >= 3 and b.below + b.above >= 3").select(F.col("user_id").alias("x"), F.round("statistic", 6).alias("chi2"))


@query("""SELECT user_id, round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, round((va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)), 5) AS df FROM (SELECT user_id,
  avg(value) FILTER (event_id % 2 = 0) AS ma, avg(value) FILTER (event_id % 2 = 1) AS mb, greatest(var_pop(value) FILTER (event_id % 2 = 0), 1 / 12.0) AS va, greatest(var_pop(value) FILTER (event_id % 2 = 1), 1 / 12.0) AS vb,
  count(*) FILTER (event_id % 2 = 0)::DOUBLE AS na, count(*) FILTER (event_id % 2 = 1)::DOUBLE AS nb FROM events GROUP BY 1) WHERE na > 1 AND nb > 1""")
def stats_welch(t: Tables) -> DataFrame:
    side = lambda s: power_sums(F.when(F.col("event_id") % 2 == s, F.col("value")))
    both = t.events.groupBy("user_id").agg(side(0).alias("a"), side(1).alias("b")).filter("a.S0 > 1 and b.S0 > 1")
    both = both.select("user_id", summary(F.col("a")).alias("a"), summary(F.col("b")).alias("b"))
    return both.select("user_id", stats.welch(F.col("a"), F.col("b")).alias("w")).select("user_id", F.round("w.diff", 6).alias("t"), F.round("w.df", 5).alias("df"))


@query()
def stats_failure_rate(t: Tables) -> DataFrame:
    """How sure each user's errors are failures, from the history of the event type; beta quantiles have no SQL."""
    fails = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).cast("double")
    per = t.events.groupBy("user_id").agg(fails.alias("fail"), (F.count(F.lit(1)) - fails).alias("passed"))
    rate = stats.confident_fail_rate(F.col("fail"), F.col("passed"))
    return per.withColumn("rate", rate).withColumn("really", stats.failure_odds(F.col("rate"), F.lit(2.0), F.lit(1.0)))


@query()
def stats_confidence(t: Tables) -> DataFrame:
    """Confidence of one-sided and median tests: the distribution functions have no SQL."""
    s = t.events.groupBy("event_type").agg(power_sums(F.col("value")).alias("s"), F.max("value").alias("hi"), F.median("value").alias("cut"))
    # A row per event type goes back to the events; counts around the median replace both samples.
    near = t.events.join(F.broadcast(s.select("event_type", "cut")), "event_type")
    side = lambda inside: stats.counts_around(F.when(inside, F.col("value")), F.col("cut"), 0)
    counts = near.groupBy("event_type").agg(side(F.col("user_id") < 50).alias("a"), side(F.col("user_id") >= 50).alias("b"))
    both = s.withColumn("m", summary(F.col("s"))).join(counts, "event_type")
    two = stats.chi2_confidence(stats.counts_statistic(F.col("a"), F.col("b")))
    return both.select("event_type", stats.single_t(F.col("hi"), F.col("m"))["confidence"].alias("one"), two.alias("two"))


@query("""SELECT event_id, (date_trunc('day', ts) - INTERVAL 1 DAY * dayofweek(ts))::TIMESTAMP AS week, date_trunc('month', ts)::TIMESTAMP AS month, (ts + INTERVAL 3 MONTH)::TIMESTAMP AS later, round((epoch_us(ts) - 1702080000000000) / 86400000000.0, 6) AS days,
  epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y%m') AS name, day(last_day(ts))::INT AS length, (ts - INTERVAL 5 HOUR)::TIMESTAMP AS east FROM events""")
def times_floor_and_add(t: Tables) -> DataFrame:
    v = F.col("ts").cast("timestamp")
    e = t.events
    start = F.timestamp_seconds(F.lit(19700 * 86400))
    return e.select(
        "event_id", times.floor(v, "week").alias("week"), times.floor(v, "month").alias("month"), times.add(v, 3, "month").alias("later"), F.round(times.diff_days(v, start), 6).alias("days"),
        F.unix_millis(v).alias("ms"), times.month_name(F.unix_millis(v)).alias("name"), times.days_in_month(v).alias("length"), times.convert(v, F.lit("GMT"), F.lit("EST")).alias("east"),
    )


@query("""SELECT event_id, CASE WHEN month(d) = 1 AND day(d) = 1 AND hour(d) < 24 THEN date_trunc('day', d) ELSE p + INTERVAL 1 DAY * (CASE dayofweek(p) WHEN 6 THEN 2 WHEN 0 THEN 1 ELSE 0 END) END::TIMESTAMP AS posted FROM
  (SELECT event_id, ts AS d, date_trunc('day', CASE WHEN hour(ts) >= 17 THEN ts + INTERVAL 1 DAY ELSE ts END) AS p FROM events)""")
def times_posting(t: Tables) -> DataFrame:
    return t.events.select("event_id", times.posting_date(F.col("ts").cast("timestamp")).alias("posted"))


@query("""SELECT event_id FROM events WHERE minute(ts) % 15 = 0 AND hour(ts) BETWEEN 9 AND 17 AND dayofweek(ts) IN (1, 3, 5)""")
def times_cron(t: Tables) -> DataFrame:
    return t.events.filter(times.cron_match(F.lit("*/15 9-17 * * 1,3,5"), F.col("ts").cast("timestamp"))).select("event_id")


@query("""SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS name, row_number() OVER (ORDER BY a) - 1 AS value, a AS min, least(a + INTERVAL 5 DAY, TIMESTAMP '2024-02-03') AS max FROM (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-03', INTERVAL 5 DAY)) AS a)""")
def times_range(t: Tables) -> DataFrame:
    return times.time_range(t.spark, dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 3), "5 day")


@query("""SELECT s, try_strptime(s, ['%Y-%m-%d', '%d/%m/%Y'])::TIMESTAMP AS at FROM (VALUES ('2024-02-29'), ('03/04/2021'), ('never'), (NULL)) v(s)""")
def times_parse(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame([("2024-02-29",), ("03/04/2021",), ("never",), (None,)], "s string")
    return rows.select("s", times.parse(F.col("s"), ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("at"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS next FROM events""")
def json_numbers(t: Tables) -> DataFrame:
    k = jsons.number(F.col("props"), "k")
    return t.events.select("event_id", k.alias("k"), (k + 1).cast("long").alias("next"))


@query("""SELECT n_nationkey, n_name AS s, n_regionkey::DOUBLE AS x, 3.0::DOUBLE AS n, round((n_nationkey + n_regionkey + 1) / 3.0, 9) AS mean, n_regionkey::DOUBLE AS second, 2 AS middle FROM nation""")
def json_arrays(t: Tables) -> DataFrame:
    text = F.format_string('{"a": {"name": "%s"}, "v": [%d, %d, 1]}', "n_name", "n_nationkey", "n_regionkey")
    rows = t.nation.select("n_nationkey", text.alias("j"))
    v = jsons.array(F.col("j"), "v")
    st = jsons.array_stats(v)
    inner = jsons.string(jsons.obj(F.col("j"), "a"), "name")
    return rows.select("n_nationkey", inner.alias("s"), jsons.item(jsons.numbers(v), 1).alias("x"), jsons.item(st, 0).alias("n"), F.round(jsons.item(st, 1), 9).alias("mean"), jsons.item(jsons.part(jsons.numbers(v), 1, 3), 0).alias("second"), F.size(jsons.part(jsons.numbers(v), 1, 3)).alias("middle"))


@query("""SELECT n_nationkey, n_nationkey * 16777216::BIGINT + 131072 + 768 + n_regionkey AS ip, lpad(hex(n_nationkey), 6, '0') AS hex_, [n_nationkey, n_regionkey] AS ints, n_regionkey::BIGINT AS last FROM nation""")
def conversions_numbers(t: Tables) -> DataFrame:
    ip = F.format_string("%d.2.3.%d", "n_nationkey", "n_regionkey")
    pair = F.concat_ws(",", "n_nationkey", F.lit("x"), "n_regionkey")
    return t.nation.select("n_nationkey", conversions.ip_number(ip).alias("ip"), conversions.hex_of(F.col("n_nationkey"), 6).alias("hex_"), conversions.integers(pair).alias("ints"), F.get(conversions.consecutive(pair), F.lit(0))["max"].alias("last"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 200 AND 320 OR o_orderkey IN (5, 7, 4000)""")
def conversions_integer_lists(t: Tables) -> DataFrame:
    packed = conversions.pack_integers([*range(200, 321), 5, 7, 4000])
    return t.orders.filter(conversions.unpack_integers(F.col("o_orderkey"), packed)).select("o_orderkey")
