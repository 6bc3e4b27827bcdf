"""Date helpers.  The clock is never read: dates come in as arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_lit(value) -> Column:
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(str(value)).cast("date")


def year_month(col) -> Column:
    """``yyyy-MM`` period label (sorts chronologically as text)."""
    return F.date_format(_c(col), "yyyy-MM")


def iso_week(col) -> Column:
    return F.weekofyear(_c(col))


def iso_week_year(col) -> Column:
    """Year the ISO week belongs to (2021-01-01 is week 53 of 2020)."""
    return F.extract(F.lit("YEAROFWEEK"), _c(col))


def months_back(as_of, months: int) -> Column:
    return F.add_months(date_lit(as_of), -months)


def within_months(col, as_of, months: int) -> Column:
    """``col`` no more than ``months`` calendar months before ``as_of``.

    Written as a plain comparison with a constant so the optimizer can fold
    it and push it to the scan (``months_between`` cannot be pushed).
    """
    return _c(col) >= months_back(as_of, months)
