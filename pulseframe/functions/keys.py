"""Batch keys derived from a date. Their number is bounded by the calendar, not by the data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spark dates run from year 1 to year 9999, which bounds the distinct month and week keys of any table.
CALENDAR_MONTHS = 9999 * 12
CALENDAR_WEEKS = 9999 * 53


def month_key(date: Column) -> Column:
    """First day of the month. Grouping by a DATE is several times cheaper than by a rendered month, so the
    label is rendered only on results."""
    return F.trunc(date, "month")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def week_start(date: Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(date, "week")
