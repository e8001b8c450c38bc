"""Dates and times as Column expressions; timestamps are UTC."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Zone letters, without D for standard time and with D for daylight time, as hours from UTC.
ZONES = {"E": "America/New_York", "C": "America/Chicago", "M": "America/Denver", "P": "America/Los_Angeles", "A": "America/Halifax"}
FIXED = {"GMT": 0, "UTC": 0, "AST": -4, "EST": -5, "CST": -6, "MST": -7, "PST": -8, "ADT": -3, "EDT": -4, "CDT": -5, "MDT": -6, "PDT": -7}
UNITS = ("MICROSECOND", "SECOND", "MINUTE", "HOUR", "DAY", "WEEK", "MONTH", "QUARTER", "YEAR")


def to_timestamp(v: Column) -> Column:
    """From a number of seconds (below 1e10) or milliseconds."""
    x = v.cast("double")
    return F.timestamp_millis(F.when(F.abs(x) < 1e10, x * 1000).otherwise(x).cast("long"))


def floor(v: Column, unit: str) -> Column:
    """Start of the unit; weeks start on Sunday."""
    if unit.upper() == "WEEK":
        return F.date_trunc("day", v) - F.make_dt_interval(F.dayofweek(v) - 1)
    return F.date_trunc(unit, v)


def add(v: Column, n: int, unit: str) -> Column:
    if unit.upper() not in UNITS:
        raise ValueError(f"unknown unit {unit}")
    return F.timestamp_add(unit.upper(), F.lit(n), v)


def diff_days(a: Column, b: Column) -> Column:
    return (F.unix_micros(a) - F.unix_micros(b)) / F.lit(86_400_000_000.0)


def is_dst(v: Column, zone: str = "America/New_York") -> Column:
    """Whether a UTC time falls into daylight time."""
    winter = F.from_utc_timestamp(F.lit(dt.datetime(2001, 1, 15)), zone)
    offset = F.unix_seconds(F.from_utc_timestamp(v, zone)) - F.unix_seconds(v)
    return offset > F.unix_seconds(winter) - F.lit(979_516_800)


def from_gmt(v: Column, letter: str) -> Column:
    return F.from_utc_timestamp(v, ZONES[letter])


def to_gmt(v: Column, letter: str) -> Column:
    return F.to_utc_timestamp(v, ZONES[letter])


def convert(v: Column, source: Column, target: Column) -> Column:
    """Between zone codes such as EST or GMT, or letters for zones with daylight time; unknown codes give null."""
    out = F.lit(None).cast("timestamp")
    utc = F.when(F.lit(False), F.lit(None).cast("timestamp"))
    for code, hours in FIXED.items():
        utc = utc.when(source == code, v - F.make_dt_interval(F.lit(0), F.lit(hours)))
    for letter, zone in ZONES.items():
        utc = utc.when(source == letter, F.to_utc_timestamp(v, zone))
    out = F.when(F.lit(False), out)
    for code, hours in FIXED.items():
        out = out.when(target == code, utc + F.make_dt_interval(F.lit(0), F.lit(hours)))
    for letter, zone in ZONES.items():
        out = out.when(target == letter, F.from_utc_timestamp(utc, zone))
    return out


def posting_date(v: Column, cutoff_hour: int = 17) -> Column:
    """Business date: after the cut-off the next day, weekends the following Monday; January 1 stays."""
    day = F.date_trunc("day", F.when(F.hour(v) >= cutoff_hour, v + F.make_dt_interval(F.lit(1))).otherwise(v))
    new_year = (F.month(v) == 1) & (F.dayofmonth(v) == 1)
    skip = F.when(F.dayofweek(day) == 7, 2).when(F.dayofweek(day) == 1, 1).otherwise(0)
    return F.when(new_year, F.date_trunc("day", v)).otherwise(day + F.make_dt_interval(skip))


def cron_field(field: Column, value: Column) -> Column:
    """Whether a cron field (``*``, ``*/n``, ``a-b`` or a list) takes a number."""
    each = lambda p: (
        (p == "*")
        | (p.rlike(r"^\*/\d+$") & (F.pmod(value, F.regexp_extract(p, r"(\d+)$", 1).try_cast("int")) == 0))
        | (p.rlike(r"^\d+-\d+$") & value.between(F.regexp_extract(p, r"^(\d+)", 1).try_cast("int"), F.regexp_extract(p, r"(\d+)$", 1).try_cast("int")))
        | (p.try_cast("int") == value)
    )
    return F.coalesce(F.exists(F.split(field, ","), lambda p: F.coalesce(each(p), F.lit(False))), F.lit(False))


def cron_match(cron: Column, at: Column) -> Column:
    """Five fields: minute, hour, day of month, month, day of week from 0 for Sunday."""
    part = lambda i: F.split_part(cron, F.lit(" "), F.lit(i))
    return (
        cron_field(part(1), F.minute(at)) & cron_field(part(2), F.hour(at)) & cron_field(part(3), F.dayofmonth(at))
        & cron_field(part(4), F.month(at)) & cron_field(part(5), F.dayofweek(at) - 1)
    )


def cron_time_of_day(cron: Column) -> Column:
    """HH:mm of a cron line with fixed minute and hour; null otherwise."""
    m, h = F.split_part(cron, F.lit(" "), F.lit(1)).try_cast("int"), F.split_part(cron, F.lit(" "), F.lit(2)).try_cast("int")
    return F.when(m.isNotNull() & h.isNotNull(), F.format_string("%02d:%02d", h, m))


def cron_duration(cron: Column) -> Column:
    """The shortest period of a cron line: minute, hour, day, week, month or year."""
    part = lambda i: F.split_part(cron, F.lit(" "), F.lit(i))
    star = lambda i: F.startswith(part(i), F.lit("*"))
    return F.when(star(1), "minute").when(star(2), "hour").when(star(3) & star(4) & star(5), "day").when(star(3) & star(4), "week").when(star(4), "month").otherwise("year")


def time_range(spark: SparkSession, low: dt.datetime, high: dt.datetime, interval: str) -> DataFrame:
    """(name, value, min, max) of consecutive intervals that cover [low, high)."""
    n, unit = interval.split()
    step = F.expr(f"interval {int(n)} {unit}")
    one = spark.range(1).select(F.explode(F.sequence(F.lit(low), F.lit(high) - F.expr("interval 1 microsecond"), step)).alias("min"))
    return one.select(F.date_format("min", "yyyy-MM-dd HH:mm:ss").alias("name"), (F.row_number().over(_by("min")) - 1).alias("value"), "min", F.least(F.col("min") + step, F.lit(high)).alias("max"))


def _by(c: str):
    from pyspark.sql import Window as W

    return W.orderBy(c)


def relative_ranges(spark: SparkSession, today: dt.date) -> DataFrame:
    """(name, min, max) of periods that reports offer: half-open, by date."""
    day = dt.timedelta(days=1)
    sunday = today - day * ((today.weekday() + 1) % 7)
    first = today.replace(day=1)

    def back(months: int) -> dt.date:
        m = first.year * 12 + first.month - 1 - months
        return dt.date(m // 12, m % 12 + 1, 1)

    rows = [("today", today, today + day), ("yesterday", today - day, today), ("this week", sunday, sunday + 7 * day), ("last week", sunday - 7 * day, sunday), ("this month", first, back(-1)), ("last month", back(1), first), ("year to date", today.replace(month=1, day=1), today + day), ("last year", dt.date(today.year - 1, 1, 1), dt.date(today.year, 1, 1)), ("all", dt.date(1970, 1, 1), today + day)]
    rows += [(f"last {n} days", today - n * day, today) for n in (7, 14, 30, 60, 90)] + [(f"last {n} weeks", sunday - 7 * n * day, sunday) for n in (2, 4, 13, 26, 52)] + [(f"last {n} months", back(n), first) for n in (2, 3, 6, 12)]
    return spark.createDataFrame(rows, "name string, min date, max date")


def parse(v: Column, formats: Sequence[str]) -> Column:
    """The first format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in formats])


def month_name(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis.cast("long")), "yyyyMM")


def days_in_month(v: Column) -> Column:
    return F.dayofmonth(F.last_day(v))


def times_of_day(spark: SparkSession, minutes: int = 1) -> DataFrame:
    """Every minute of a day, as (tod, minute)."""
    m = spark.range(0, 1440, minutes).select(F.col("id").cast("int").alias("minute"))
    return m.select(F.format_string("%02d:%02d", F.floor(F.col("minute") / 60).cast("int"), F.col("minute") % 60).alias("tod"), "minute")


def horizon(pushed: Column, now: Column) -> Column:
    """The first of 7, 30, 60 and 90 days that exceeds the age; null beyond."""
    age = diff_days(now, pushed)
    return F.when(age < 7, 7).when(age < 30, 30).when(age < 60, 60).when(age < 90, 90)
