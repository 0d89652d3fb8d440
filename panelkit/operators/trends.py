"""Totals per day, ISO week and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..binding import Panel
from ..functions.calendar import (
    LEVELS,
    bucket_label,
    iso_week,
    month_label,
    month_of,
    week_year_of,
    year_of,
)
from ..functions.values import clean_name
from .rows import filter_month
from .totals import sums


def daily_totals(p: Panel, by: str | None = None) -> DataFrame:
    """Both measures per group and date, in that order."""
    by = by or p.entity
    return p.df.groupBy(by, p.date).agg(*sums(p)).orderBy(by, p.date)


def trend(p: Panel, level: str, by: str | None = None, week_year: str = "iso") -> DataFrame:
    """Both measures per day, week (year, week) or month (year, month), over all or per group."""
    if level == "day":
        buckets = {p.date: F.col(p.date)}
    elif level == "week":
        buckets = {"year": week_year_of(p.date, week_year), "week": iso_week(p.date)}
    elif level == "month":
        buckets = {"year": year_of(p.date), "month": month_of(p.date)}
    else:
        raise ValueError(f"unknown calendar level: {level}")
    keys = ([F.col(by)] if by else []) + [c.alias(name) for name, c in buckets.items()]
    names = ([by] if by else []) + list(buckets)
    return p.df.groupBy(*keys).agg(*sums(p)).orderBy(*names)


def multi_trend(p: Panel, week_year: str = "iso") -> DataFrame:
    """Day, week and month totals per entity from one scan, tagged with level and bucket label.

    Rows are first summed per entity and day; only those sums are tripled, never the input rows.
    """
    daily = p.df.groupBy(p.entity, p.date).agg(*sums(p))
    tags = F.array(
        *[
            F.struct(F.lit(level).alias("level"), bucket_label(p.date, level, week_year).alias("bucket"))
            for level in LEVELS
        ]
    )
    measures = [f"total_{m}" for m in p.measures]
    return (
        daily.withColumn("tag", F.explode(tags))
        .groupBy(p.entity, "tag.level", "tag.bucket")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def tagged_key(df: DataFrame, entity: str) -> DataFrame:
    """The ``entity|bucket`` text key of a ``multi_trend`` result, for text output."""
    return df.select(
        F.concat_ws("|", entity, "bucket").alias("key"),
        *[c for c in df.columns if c not in (entity, "level", "bucket")],
    )


def monthly_by_entity(p: Panel) -> DataFrame:
    """Cases per month label and cleaned entity name.

    Labels and names are made from the sums per month and raw name, not from the rows.
    """
    total = f"total_{p.cases}"
    raw = (
        p.df.na.drop(subset=[p.date, p.entity])
        .groupBy(F.trunc(p.date, "month").alias("start"), p.entity)
        .agg(*sums(p, [p.cases]))
    )
    return (
        raw.groupBy(month_label("start").alias("month"), clean_name(p.entity).alias("label"))
        .agg(F.sum(total).alias(total))
    )


def month_snapshot(p: Panel, month: str | None = None) -> DataFrame:
    """Cases per cleaned entity name in one month; the latest month present when none is named.

    Either way the month is a filter on the date before anything is summed. The latest is that of
    the whole panel: its dates are read once more, but no other column of any other month.
    """
    if month is not None:
        return monthly_by_entity(filter_month(p, month))
    latest = p.df.agg(F.trunc(F.max(p.date), "month").alias("latest")).scalar()
    return monthly_by_entity(p.where(F.col(p.date) >= latest))


def daily_series(p: Panel) -> DataFrame:
    """Cases per date over all entities, in date order."""
    return p.df.na.drop(subset=[p.date]).groupBy(p.date).agg(*sums(p, [p.cases])).orderBy(p.date)


def daily_record_counts(p: Panel) -> DataFrame:
    """Number of rows per date, in date order."""
    return p.df.groupBy(p.date).agg(F.count("*").alias("record_count")).orderBy(p.date)
