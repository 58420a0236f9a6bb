"""Validity, interval and text-comparison predicates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from martkit.functions.dates import HIGH_DATE, or_high


def current_rows(df: DataFrame, close: str = "close_dt") -> DataFrame:
    """Rows of a history table that are still open."""
    return df.filter(F.col(close) == F.lit(HIGH_DATE))


def valid_at(day: Column, opened: Column, closed: Column, grace: int = 0) -> Column:
    """``day`` lies in the row's validity, which may start ``grace`` days early.

    The bounds stay bare columns, so that both reach the scan when ``day`` is a literal.
    """
    latest = F.date_add(day, grace) if grace else day
    return (opened <= latest) & (closed >= day)


def in_interval(day: Column, start: Column, end: Column, end_grace: int = 0) -> Column:
    """``day`` lies in a business interval; a missing end is open, the end may be stretched."""
    last = F.date_add(or_high(end), end_grace) if end_grace else or_high(end)
    return day.between(start, last)


def open_on(day: date, start: Column, end: Column) -> Column:
    """The interval of two moments holds some moment of a day; a missing end is open.

    Bare columns against literals, so that the scan can skip row groups.
    """
    return (start < F.lit(day + timedelta(days=1))) & (end.isNull() | (end >= F.lit(day)))


def on_days(moment: Column, start: date, end: date) -> Column:
    """A timestamp falls on one of the days ``start``..``end``, the last day whole.

    A half-open range on the bare column, so that the scan can skip row groups.
    """
    return (moment >= F.lit(start)) & (moment < F.lit(end + timedelta(days=1)))


def folded(column: Column) -> Column:
    """Comparison form of text: letter case and trailing blanks do not count."""
    return F.lower(F.rtrim(column))


def same_text(left: Column, right: Column | str) -> Column:
    if isinstance(right, str):
        return folded(left) == F.lit(right.rstrip(" ").lower())
    return folded(left) == folded(right)


def text_in(column: Column, *values: str) -> Column:
    return folded(column).isin(*[v.rstrip(" ").lower() for v in values])


def holds(condition: Column) -> Column:
    """True only where the condition is true; unknown becomes false."""
    return F.coalesce(condition, F.lit(False))
