"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def compact_day(col) -> Column:
    """``yyyyMMdd`` text of a date (run folder naming)."""
    return F.date_format(_c(col), "yyyyMMdd")


def date_id(col) -> Column:
    """Smart integer key of a date: yyyymmdd."""
    d = _c(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_of(col) -> Column:
    return F.year(_c(col))


def month_of(col) -> Column:
    return F.month(_c(col))
