"""Date helpers expressed as built-in Spark expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date_col(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, str):
        d = dt.date.fromisoformat(d)
    return F.lit(d)


def month_boundaries(start: Column, end: Column) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    This is the calendar-month difference (Jan 31 -> Feb 1 is 1), not
    ``months_between``.  Negative when ``end`` is before ``start``.
    """
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def in_closed(col: Column, lo: Column, hi: Column) -> Column:
    return (col >= lo) & (col <= hi)


def full_months(start: Column, end: Column) -> Column:
    """Whole calendar months elapsed from ``start`` to ``end`` (tenure)."""
    return (month_boundaries(start, end)
            - F.when(F.dayofmonth(end) < F.dayofmonth(start), F.lit(1)).otherwise(F.lit(0))).cast("int")
