"""Scalar column functions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_column

DAY_FIRST = "dd/MM/yyyy"
LEVELS = ("day", "week", "month")


def to_day(c: str | Column, fmt: str = DAY_FIRST) -> Column:
    """Text to date by an explicit format; null where it does not parse."""
    return F.try_to_date(as_column(c), fmt)


def year_of(c: str | Column) -> Column:
    return F.year(as_column(c))


def month_of(c: str | Column) -> Column:
    return F.month(as_column(c))


def iso_week(c: str | Column) -> Column:
    return F.weekofyear(as_column(c))


def week_year_of(c: str | Column, week_year: str = "iso") -> Column:
    """The year a week is counted in: the ISO year, or the plain calendar year of the day."""
    if week_year == "iso":
        return F.extract(F.lit("YEAROFWEEK"), as_column(c))
    if week_year == "calendar":
        return F.year(as_column(c))
    raise ValueError(f"unknown week year: {week_year}")


def month_label(c: str | Column) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def bucket_label(c: str | Column, level: str, week_year: str = "iso") -> Column:
    """``2020-03-01``, ``2020-W09`` or ``2020-03``."""
    if level == "day":
        return F.date_format(as_column(c), "yyyy-MM-dd")
    if level == "week":
        year = F.lpad(week_year_of(c, week_year).cast("string"), 4, "0")
        return F.concat(year, F.lit("-W"), F.lpad(iso_week(c).cast("string"), 2, "0"))
    if level == "month":
        return month_label(c)
    raise ValueError(f"unknown calendar level: {level}")


def month_start(year: str | Column, month: str | Column) -> Column:
    return F.make_date(as_column(year), as_column(month), F.lit(1))
