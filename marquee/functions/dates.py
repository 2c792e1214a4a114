"""Calendar expressions and the calendar spine.

The spine is generated from two dates with ``sequence`` + ``explode``; its
size is bounded by the number of days between the bounds (9,497 for the
default 2000-01-01 .. 2025-12-31), never by the fact table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of

# The default calendar bounds, end exclusive.
DEFAULT_SPINE_START = "2000-01-01"
DEFAULT_SPINE_END = "2026-01-01"


def date_key(c: Column | str) -> Column:
    """Integer key YYYYMMDD."""
    d = col_of(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(c: Column | str) -> Column:
    """0 = Sunday .. 6 = Saturday (Spark's ``dayofweek`` is 1..7)."""
    return (F.dayofweek(col_of(c)) - 1).cast("int")


def is_weekend(c: Column | str) -> Column:
    return F.dayofweek(col_of(c)).isin(1, 7)


def quarter_no(month: Column | str) -> Column:
    """INT((m + 2) / 3)."""
    return F.floor((col_of(month) + 2) / 3).cast("int")


def quarter_label(q: Column | str) -> Column:
    return F.concat(F.lit("Qtr "), col_of(q).cast("string"))


def month_full_name(month: Column | str) -> Column:
    """'January' .. 'December' from a month number."""
    return F.date_format(F.make_date(F.lit(2000), col_of(month), F.lit(1)), "MMMM")


def calendar_columns(d: Column | str) -> list[Column]:
    """The dimension columns of one calendar day."""
    day = col_of(d)
    return [
        date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).cast("int").alias("year"),
        F.quarter(day).cast("int").alias("quarter"),
        F.month(day).cast("int").alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.dayofmonth(day).cast("int").alias("day"),
        day_of_week0(day).alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    ]


def spine(spark, start: str | dt.date = DEFAULT_SPINE_START,
          end_exclusive: str | dt.date = DEFAULT_SPINE_END) -> DataFrame:
    """Dense daily spine [start, end) as one ``date_day`` column."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(str(start))),
                             F.date_sub(F.to_date(F.lit(str(end_exclusive))), 1),
                             F.expr("interval 1 day"))).alias("date_day"))


def spine_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Spine over [lo, hi] (inclusive) taken from a one-row frame of bounds."""
    return bounds.select(
        F.explode(F.sequence(F.col(lo), F.col(hi), F.expr("interval 1 day"))).alias("date_day"))


def year_padded_bounds(df: DataFrame, c: str) -> DataFrame:
    """One row: Jan 1 of the first year and Dec 31 of the last year of ``c``."""
    return df.agg(F.min(c).alias("_mn"), F.max(c).alias("_mx")).select(
        F.make_date(F.year("_mn"), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year("_mx"), F.lit(12), F.lit(31)).alias("hi"))


def day_range(ts: Column | str, day: str | dt.date) -> Column:
    """``ts`` falls on calendar ``day``; a range form so it reaches the scan."""
    t = col_of(ts)
    d0 = F.to_timestamp_ntz(F.lit(f"{day} 00:00:00"))
    return (t >= d0) & (t < d0 + F.expr("interval 1 day"))


def local_from_utc_dst_approx(utc: Column | str) -> Column:
    """UTC + 2 h in months 4..10, otherwise + 1 h (approximate summer time)."""
    u = col_of(utc)
    return F.when(F.month(u).between(4, 10), u + F.expr("interval 2 hours")) \
        .otherwise(u + F.expr("interval 1 hour"))
