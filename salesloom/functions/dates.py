"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column | str) -> Column:
    """ISO date or NULL; never fails on malformed text."""
    return F.try_to_date(c, "yyyy-MM-dd")


def elapsed_months(first: Column, later: Column) -> Column:
    """Full months elapsed: the calendar difference, less one while the day of month is not yet reached."""
    calendar = (F.year(later) - F.year(first)) * 12 + (F.month(later) - F.month(first))
    return calendar - F.when(F.dayofmonth(later) < F.dayofmonth(first), 1).otherwise(0)


def month_label(d: Column | str) -> Column:
    return F.date_format(d, "yyyy-MM")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def month_start(d: Column | str) -> Column:
    return F.trunc(d, "MM").cast("date")


def dow_sunday0(d: Column) -> Column:
    """Sunday = 0 .. Saturday = 6 (warehouse calendar)."""
    return F.dayofweek(d) - 1


def dow_monday0(d: Column) -> Column:
    """Monday = 0 .. Sunday = 6 (BI calendar, forecasting)."""
    return F.weekday(d)
