"""Months, seasons and water years as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Days from the first of January of year 1, which is day 1, to 1970-01-01.
EPOCH_ORDINAL = 719163


def month_of(date: Column) -> Column:
    """First day of the month."""
    return F.trunc(date, "MM").cast("date")


def month_key(date: Column) -> Column:
    """'YYYY-MM'."""
    return F.date_format(date, "yyyy-MM")


def month_number(date: Column) -> Column:
    """Months since January 1970."""
    return (F.year(date) - 1970) * 12 + F.month(date) - 1


def month_from_number(n: Column) -> Column:
    return F.add_months(F.lit("1970-01-01").cast("date"), n.cast("int"))


def month_code(key: Column) -> Column:
    """'YYYY-MM' as the number YYYYMM, 0 if empty or null."""
    return F.when(F.coalesce(F.length(key), F.lit(0)) == 0, 0).otherwise(F.replace(key, F.lit("-"), F.lit("")).try_cast("int"))


def ordinal(date: Column) -> Column:
    """Proleptic ordinal: 0001-01-01 is 1."""
    return F.unix_date(date) + EPOCH_ORDINAL


def from_ordinal(n: Column) -> Column:
    return F.date_from_unix_date((n - EPOCH_ORDINAL).cast("int"))


def mid_month_doy(year: Column, month: Column) -> Column:
    return F.dayofyear(F.make_date(year, month, F.lit(15)))


def doy_in_window(doy: Column, start: Column | int | None, end: Column | int | None) -> Column:
    """Inclusive window of days of the year that may wrap the new year; open where a bound is null."""
    a, b = (F.lit(x) if not isinstance(x, Column) else x for x in (start, end))
    inside = F.when(a <= b, doy.between(a, b)).otherwise((doy >= a) | (doy <= b))
    return F.when(a.isNull() | b.isNull(), F.lit(True)).otherwise(inside)


def in_season(date: Column, first: int, last: int) -> Column:
    """Months of the year from first to last, inclusive."""
    return F.month(date).between(first, last)


def water_year(date: Column, start_month: int = 10) -> Column:
    """Year in which the water year that holds the date began."""
    return F.year(F.add_months(date, 13 - start_month)) - 1


def water_month(date: Column, start_month: int = 10) -> Column:
    """Place of the month in its water year, from 1."""
    return F.pmod(F.month(date) - start_month, F.lit(12)) + 1


def doy_cycle(date: Column) -> tuple[Column, Column]:
    """Sine and cosine of the day of the year."""
    turn = F.lit(2.0) * F.pi() * F.dayofyear(date) / F.lit(365.25)
    return F.sin(turn), F.cos(turn)


def harmonics(date: Column, n: int = 3) -> list[Column]:
    """cos and sin of 1..n turns a year."""
    turn = F.lit(2.0) * F.pi() * F.dayofyear(date) / F.lit(365.25)
    return [f(turn * k) for k in range(1, n + 1) for f in (F.cos, F.sin)]
