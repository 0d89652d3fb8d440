"""Running totals in date order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..binding import Panel
from .totals import sums


def _running(df: DataFrame, columns: dict[str, str], window) -> DataFrame:
    up_to_here = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({name: F.sum(c).over(up_to_here) for c, name in columns.items()})


def cumulative(p: Panel, by: str | None = None) -> DataFrame:
    """Daily and running totals per group and date.

    Rows are summed per group and day before the window, so a group has at most one row per day
    in it, however many input rows it holds.
    """
    by = by or p.entity
    daily = p.df.groupBy(by, p.date).agg(*sums(p))
    names = {f"total_{m}": f"cumulative_{m}" for m in p.measures}
    return _running(daily, names, Window.partitionBy(by).orderBy(p.date))


def cumulative_records(p: Panel, by: str | None = None) -> DataFrame:
    """Running totals with one row per group, date and entity; ties on a date run in entity order.

    A group is not run through in one piece: each day is run on its own, and the total of the
    days before it is added. The first is per (group, date), the second has one row per day.
    """
    by = by or p.area
    keys = [by, p.date]
    records = p.df.groupBy(*dict.fromkeys([*keys, p.entity])).agg(*sums(p))
    names = {f"total_{m}": f"cumulative_{m}" for m in p.measures}
    within = _running(records, names, Window.partitionBy(*keys).orderBy(p.entity))

    daily = records.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    earlier = Window.partitionBy(by).orderBy(p.date).rowsBetween(Window.unboundedPreceding, -1)
    before = daily.select(
        *[F.col(k).alias(f"before_{k}") for k in keys],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in names],
    )
    same_day = [F.col(k).eqNullSafe(F.col(f"before_{k}")) for k in keys]
    return within.join(before, same_day).select(
        *records.columns,
        *[(F.col(name) + F.col(f"before_{c}")).alias(name) for c, name in names.items()],
    )


def cumulative_final(p: Panel) -> DataFrame:
    """The last running total of each entity, with its latest date. Needs no window."""
    return p.df.groupBy(p.entity).agg(
        F.max(p.date).alias("last_date"),
        *[s.alias(f"cumulative_{m}") for s, m in zip(sums(p), p.measures)],
    )
