"""Period and date functions (F1, F2, F9, F10) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference's period spellings and day-first date text.
RAW_PERIOD_SEPARATOR = "_"  # raw periods look like 2025_3
RAW_DATE_FORMAT = "dd.MM.yy"  # raw DATA looks like 31.03.25
PIVOT_YEAR_2DIGIT = 70  # two-digit years 70..99 are 19xx, 00..69 are 20xx


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_of_raw_period(period: Column | str) -> Column:
    """month number of a ``YYYY_M`` period (``split_part`` + cast)."""
    return F.split_part(_c(period), F.lit(RAW_PERIOD_SEPARATOR), F.lit(2)).try_cast("int")


def period_index(period: Column | str) -> Column:
    """Sortable month key year*12+month for ``YYYY_M`` and ``YYYY-MM`` text."""
    parts = F.split(_c(period), "[_-]")
    return (parts.getItem(0).try_cast("int") * 12 + parts.getItem(1).try_cast("int")).cast("int")


def month_number(period: str) -> int:
    """``period_index`` of one literal."""
    year, month = period.replace("-", RAW_PERIOD_SEPARATOR).split(RAW_PERIOD_SEPARATOR)[:2]
    return int(year) * 12 + int(month)


def raw_date(text: Column | str) -> Column:
    """``TO_DATE(x, 'DD.MM.YY')`` with the SQL two-digit-year rule.

    Spark reads ``95`` as 2095; the source system means 1995, so years at or
    past 2070 move back a century.
    """
    d = F.to_date(_c(text), RAW_DATE_FORMAT)
    return F.when(F.year(d) >= 2000 + PIVOT_YEAR_2DIGIT, F.add_months(d, -1200)).otherwise(d)


def period_start(period: Column | str) -> Column:
    """``2025_3`` and ``2025-03`` both become the date 2025-03-01."""
    parts = F.split(_c(period), "[_-]")
    return F.make_date(parts.getItem(0).try_cast("int"), parts.getItem(1).try_cast("int"), F.lit(1))


def raw_period_of(d: Column | str) -> Column:
    """``YYYY_M`` text of a date (month without a leading zero)."""
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit(RAW_PERIOD_SEPARATOR), F.month(d).cast("string"))


def is_weekend(d: Column | str) -> Column:
    """day of week of the date is Saturday or Sunday (Monday = 0 .. Sunday = 6)."""
    return F.weekday(_c(d)) >= 5


def period_index_of_date(d: Column | str) -> Column:
    d = _c(d)
    return (F.year(d) * 12 + F.month(d)).cast("int")
