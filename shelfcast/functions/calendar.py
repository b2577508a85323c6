"""Calendar columns of a date (P-01..P-06, P-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEMPORAL_FEATURES = [
    "year", "month", "day", "day_of_week", "week_of_year", "quarter",
    "is_weekend", "is_month_start", "is_month_end", "is_payday",
]


def temporal_columns(date: str | Column = "date") -> list[Column]:
    """year, month, day, day_of_week (Monday = 0), ISO week, quarter and 0/1 day flags."""
    d = F.col(date) if isinstance(date, str) else date
    month_end = d == F.last_day(d)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        (F.weekday(d) >= 5).cast("int").alias("is_weekend"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        month_end.cast("int").alias("is_month_end"),
        ((F.dayofmonth(d) == 15) | month_end).cast("int").alias("is_payday"),
    ]


def day_name(date: str | Column = "date") -> Column:
    d = F.col(date) if isinstance(date, str) else date
    return F.date_format(d, "EEEE")


def in_periods(date: str | Column, periods) -> Column:
    """1 when the date falls in any closed [start, end] period, else 0."""
    d = F.col(date) if isinstance(date, str) else date
    cond = F.lit(False)
    for a, b in periods:
        cond = cond | d.between(F.lit(a), F.lit(b))
    return cond.cast("int")


def day_number(date: str | Column = "date") -> Column:
    """Days since 1970-01-01: an integer order key for calendar (RANGE) window frames."""
    d = F.col(date) if isinstance(date, str) else date
    return F.unix_date(d)
