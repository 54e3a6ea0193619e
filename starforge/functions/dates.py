"""Calendar expressions (F-05..F-13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """``yyyyMMdd`` integer of a date or timestamp (F-06); NULL stays NULL."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(c) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday (F-05)."""
    return (F.dayofweek(_c(c)) - 1).cast("int")


def is_weekend(c) -> Column:
    return day_of_week0(c).isin(0, 6)


def month_name(c) -> Column:
    """Full month name, not blank padded (F-07)."""
    return F.date_format(_c(c), "MMMM")


def day_name(c) -> Column:
    return F.date_format(_c(c), "EEEE")


def fiscal_year(c, start_month: int = 10) -> Column:
    """Fiscal year that starts in ``start_month`` and is named by its end year (F-09)."""
    d = _c(c)
    if start_month == 1:
        return F.year(d).cast("int")
    return F.when(F.month(d) >= start_month, F.year(d) + 1).otherwise(F.year(d)).cast("int")


def fiscal_quarter(c, start_month: int = 10) -> Column:
    """Quarter within the fiscal year: months since its start divided by 3, plus 1."""
    shifted = F.pmod(F.month(_c(c)) - F.lit(start_month), F.lit(12))
    return (F.floor(shifted / 3) + 1).cast("int")


def completed_years(birth, ref) -> Column:
    """Age in completed years at ``ref`` (F-13).

    Year difference, minus one when the (month, day) of ``ref`` comes before the
    birthday. Someone born on 29 February turns a year older on 1 March in
    common years.
    """
    b, r = F.to_date(_c(birth)), F.to_date(_c(ref))
    before = (F.month(r) * 100 + F.dayofmonth(r)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(r) - F.year(b) - F.when(before, 1).otherwise(0)).cast("int")


def month_start(c) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(_c(c)), "month")
