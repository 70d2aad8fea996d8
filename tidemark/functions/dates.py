"""Calendar expressions over half-open month windows and inclusive publication intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_between(start: Column, end: Column) -> Column:
    """Whole calendar months from the month of start to that of end."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def months(start: Column, end: Column) -> Column:
    """First days of the months of the half-open window [start, end)."""
    last = F.add_months(month_start(end), -1)
    return F.when(month_start(start) <= last, F.sequence(month_start(start), last, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def halves(start: Column, end: Column) -> Column:
    """A window of two or more months as its two halves; the left one has the smaller half of the months."""
    middle = F.add_months(start, F.floor(months_between(start, end) / 2).cast("int"))
    return F.array(F.struct(start.alias("window_start"), middle.alias("window_end")), F.struct(middle.alias("window_start"), end.alias("window_end")))


def months_touched(first: Column, last: Column) -> Column:
    """First days of every month that the inclusive interval touches, partial ones included."""
    return F.sequence(month_start(first), month_start(last), F.expr("interval 1 month"))


def is_complete_month(month: Column, first: Column, last: Column) -> Column:
    return (first <= month) & (last >= F.last_day(month))


def complete_years(first: Column, last: Column) -> Column:
    """Calendar years that the inclusive interval covers from the first day to the last."""
    years = F.sequence(F.year(first), F.year(last))
    return F.filter(years, lambda y: (first <= F.make_date(y, F.lit(1), F.lit(1))) & (last >= F.make_date(y, F.lit(12), F.lit(31))))


def utc_month(ts: Column) -> Column:
    """First day of the month of an instant; the session's time zone is UTC."""
    return F.date_trunc("MONTH", ts).cast("date")


def iso_date(text: Column) -> Column:
    """A date from exactly yyyy-MM-dd, else null."""
    return F.when(F.length(text) == 10, F.try_to_date(text, "yyyy-MM-dd"))


def utc_instant(text: Column) -> Column:
    """A timestamp: without offset it is UTC, with one it is converted, invalid text is null."""
    return F.try_to_timestamp(text)


def epoch_seconds(day: Column) -> Column:
    return F.unix_timestamp(day.cast("timestamp"))


def recent_days(today: Column, days: int = 30) -> Column:
    """The completed days before today, oldest first."""
    return F.sequence(F.date_sub(today, days), F.date_sub(today, 1), F.expr("interval 1 day"))
