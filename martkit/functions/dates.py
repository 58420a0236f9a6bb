"""Load windows, month ends and date arithmetic."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

# The open-end date of history rows and the floor used when ordering missing dates.
HIGH_DATE = date(2899, 12, 31)
LOW_DATE = date(1901, 1, 1)


def rolling_window(as_of: date, back: int = 12, lag: int = 2) -> tuple[date, date]:
    """Inclusive reload window.  Plain dates, so that scans see constants and prune partitions."""
    return as_of - timedelta(days=back), as_of - timedelta(days=lag)


def prev_month_end(as_of: date | Column) -> date | Column:
    """Last day of the month before ``as_of``, for a date or a date column."""
    if isinstance(as_of, Column):
        return F.last_day(F.add_months(as_of, -1))
    return as_of.replace(day=1) - timedelta(days=1)


def or_high(column: Column) -> Column:
    """Open end: a missing date counts as the high date."""
    return F.coalesce(column, F.lit(HIGH_DATE))


def or_low(column: Column) -> Column:
    return F.coalesce(column, F.lit(LOW_DATE))


def same_month(left: Column, right: Column) -> Column:
    """Same calendar month of the same year (a two-digit year label would mix centuries)."""
    return F.trunc(left, "MM") == F.trunc(right, "MM")


def month_label(column: Column) -> Column:
    """Display label such as ``Aug-98``."""
    return F.date_format(column, "MMM-yy")


def iso_text(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")
