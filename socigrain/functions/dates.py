"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

POST_TIME_PATTERN = "MMM dd HH:mm:ss Z yyyy"


def parse_post_time(text: Column) -> Column:
    """'Sun Jul 17 11:27:28 +0000 2022' -> timestamp; Spark 3+ refuses to parse the weekday."""
    return F.to_timestamp(F.regexp_replace(text, "^[A-Za-z]{3} ", ""), POST_TIME_PATTERN)


def monday_week_label(ts: Column) -> Column:
    """``%Y-%W``: Monday-first week of the year, days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(ts) + F.lit(6) - F.weekday(ts)) / F.lit(7)).cast("int")
    return F.format_string("%d-%02d", F.year(ts), week)


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def quarter_label(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The calendar fields of a clean post; ``week`` is ISO, ``week_name`` is Monday-first."""
    return {
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "quarter_name": quarter_label(ts),
        "month": F.month(ts),
        "month_name": F.date_format(ts, "yyyy-MM"),
        "week": F.weekofyear(ts),
        "week_name": monday_week_label(ts),
        "day": F.dayofmonth(ts),
        "day_name": F.date_format(ts, "yyyy-MM-dd"),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "second": F.second(ts),
    }
