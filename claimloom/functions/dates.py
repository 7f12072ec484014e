"""Calendar helpers at month grain."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_number(day: Column) -> Column:
    """Months since year zero; differences are whole months."""
    return F.year(day) * 12 + F.month(day)


def months_from(day: Column, origin: date) -> Column:
    return (month_number(day) - F.lit(origin.year * 12 + origin.month)).cast("int")


def month_spine(first: date, last: date) -> Column:
    """Array of month starts between two dates, both included."""
    start = F.lit(first.replace(day=1)).cast("date")
    return F.sequence(start, F.lit(last.replace(day=1)).cast("date"), F.expr("interval 1 month"))


def month_end(month: Column, reporting_end: date) -> Column:
    """Last day of the month, not beyond the end of reporting."""
    return F.least(F.last_day(month), F.lit(reporting_end).cast("date"))
