"""Library functions under SQL names: SQL functions and table functions that Spark's optimiser inlines into the query."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name(parameters) → (returned type, body). Bodies are SQL, so that a call costs no more than the expression written out.
SCALAR = {
    "string_deformat(v STRING)": ("STRING", "regexp_replace(v, '[^A-Za-z0-9]', '')"),
    "string_remove_control(v STRING)": ("STRING", r"regexp_replace(v, '[\\x00-\\x1f]', ' ')"),
    "string_get_word(v STRING, delimiter STRING, n INT)": ("STRING", "split_part(v, delimiter, n + 1)"),
    "string_word_count(v STRING, delimiter STRING)": ("INT", "CASE WHEN v IS NOT NULL THEN (length(v) - length(replace(v, delimiter, ''))) DIV length(delimiter) + 1 END"),
    "string_locate(needle STRING, v STRING)": ("INT", "CASE WHEN locate(needle, v) = 0 THEN length(v) + 1 ELSE locate(needle, v) END"),
    "string_between(v STRING, low STRING, high STRING)": (
        "STRING",
        "CASE WHEN locate(low, v) > 0 AND locate(high, v, locate(low, v) + length(low)) > 0 THEN substr(v, locate(low, v) + length(low), locate(high, v, locate(low, v) + length(low)) - locate(low, v) - length(low)) END",
    ),
    "string_left(v STRING, n INT)": ("STRING", "substr(v, 1, greatest(n, 0))"),
    "string_right(v STRING, n INT)": ("STRING", "substr(v, greatest(length(v) - greatest(n, 0), 0) + 1)"),
    "math_zero2null(v DOUBLE)": ("DOUBLE", "nullif(v, 0)"),
    "math_percent(v DOUBLE)": ("STRING", "concat(cast(round(v * 100, 0) AS BIGINT), '%')"),
    "math_floor_to(v DOUBLE, step DOUBLE)": ("DOUBLE", "floor(v / step) * step"),
    "time_floor_week(v TIMESTAMP)": ("TIMESTAMP", "date_trunc('day', v) - make_interval(0, 0, 0, dayofweek(v) - 1)"),
    "time_milli(v TIMESTAMP)": ("BIGINT", "unix_millis(v)"),
    "json_number(v STRING, path STRING)": ("DOUBLE", "try_cast(get_json_object(v, concat('$.', path)) AS DOUBLE)"),
}
TABLE = {
    "time_parts(low TIMESTAMP, high TIMESTAMP, days INT)": ("part INT, start TIMESTAMP, stop TIMESTAMP", "SELECT pos, col, least(col + make_interval(0, 0, 0, days), high) FROM posexplode(CASE WHEN low < high THEN sequence(low, high - INTERVAL 1 MICROSECOND, make_interval(0, 0, 0, days)) ELSE array() END)"),
    "string_words(v STRING, delimiter STRING)": ("n INT, word STRING", "SELECT pos, col FROM posexplode(split(v, concat('\\\\Q', delimiter, '\\\\E')))"),
    "digits_below(n INT)": ("value INT", "SELECT col FROM explode(CASE WHEN n > 0 THEN sequence(0, n - 1) ELSE array() END)"),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; their names."""
    for head, (kind, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    for head, (columns, body) in TABLE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE({columns}) RETURN {body}")
    return [head.split("(")[0] for head in (*SCALAR, *TABLE)]
