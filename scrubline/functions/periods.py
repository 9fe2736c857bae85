"""Reporting periods and cutoffs, each a Column function of a run-date Column.

With ``F.lit(date)`` as the argument Catalyst folds them to literals, so a period filter prunes partitions.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(as_of: Column, months_back: int = 0) -> Column:
    """First day of the run date's month, or of a month before it."""
    return F.add_months(F.trunc(as_of, "MM"), -months_back)


def me_period(as_of: Column) -> Column:
    """Previous month as an int, yyyymm."""
    last_month = month_start(as_of, 1)
    return F.year(last_month) * 100 + F.month(last_month)


def date_key(as_of: Column) -> Column:
    """Last day of the previous month as an int, yyyymmdd."""
    return me_period(as_of) * 100 + F.day(F.date_sub(month_start(as_of), 1))


def sale_cutoff_current(as_of: Column) -> Column:
    return month_start(as_of, 2)


def sale_cutoff_month_end(as_of: Column) -> Column:
    return month_start(as_of, 3)


def next_due_cutoff_pooled(as_of: Column) -> Column:
    return month_start(as_of, 3)


def next_due_cutoff_balance_sheet(as_of: Column) -> Column:
    return month_start(as_of, 1)


def months_crossed(start: Column, end: Column) -> Column:
    """Calendar-month boundaries between two dates (not whole elapsed months)."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
