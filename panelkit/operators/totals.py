"""Grouped totals, ratios, rates and statistics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..binding import Panel
from ..functions.calendar import month_label
from ..functions.values import clean_name, guarded, number_in, scale, zero_if_null
from .rows import require_cols, strict_rows


def sums(p: Panel, measures: Sequence[str] | None = None) -> list:
    return [
        zero_if_null(F.sum(number_in(p.df, m))).alias(f"total_{m}") for m in (measures or p.measures)
    ]


def totals(
    p: Panel,
    by: str | Sequence[str],
    measures: Sequence[str] | None = None,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Sum of each measure per group as ``total_<measure>``; nulls count as nothing."""
    keys = [by] if isinstance(by, str) else list(by)
    df = p.df.na.drop(subset=keys) if drop_null_keys else p.df
    return df.groupBy(*keys).agg(*sums(p, measures))


def area_totals(p: Panel, measure: str | None = None) -> DataFrame:
    """One measure per area, largest first."""
    measure = measure or p.deaths
    return totals(p, p.area, [measure]).orderBy(F.desc(f"total_{measure}"), p.area)


def area_comparison(p: Panel) -> DataFrame:
    """Both measures per area, in area order."""
    return totals(p, p.area).orderBy(p.area)


def ratio(p: Panel, strict: bool = False) -> DataFrame:
    """Deaths per case of each entity; 0 where there are no cases."""
    grouped = totals(strict_rows(p) if strict else p, p.entity)
    cases, deaths = F.col(f"total_{p.cases}"), F.col(f"total_{p.deaths}")
    return grouped.withColumn("ratio", guarded(cases > 0, scale(deaths, cases), 0.0))


def rate_per(
    p: Panel,
    measures: Sequence[str] | None = None,
    per: int = 100_000,
    split_by_pop: bool = False,
    require_pop: bool = False,
) -> DataFrame:
    """Measures per ``per`` inhabitants of each entity; 0 where the population is null or 0.

    ``split_by_pop`` groups by population as well, for a population that changes over time.
    ``require_pop`` drops rows without population before summing.
    """
    measures = list(measures or p.measures)
    if require_pop:
        p = require_cols(p, [*measures, p.pop])
    pop = number_in(p.df, p.pop)
    if split_by_pop:
        grouped = p.df.groupBy(p.entity, pop.alias("population")).agg(*sums(p, measures))
    else:
        grouped = p.df.groupBy(p.entity).agg(F.max(pop).alias("population"), *sums(p, measures))
    population = F.col("population")
    return grouped.withColumns(
        {
            f"{m}_per_{per}": guarded(population > 0, scale(f"total_{m}", population, per), 0.0)
            for m in measures
        }
    )


def rate_stats(p: Panel, rate: str | None = None) -> DataFrame:
    """Mean, largest and smallest value of a dirty numeric column per entity, highest mean first."""
    value = number_in(p.df, rate or p.rate, "double")
    return (
        p.df.select(p.entity, value.alias("rate_value"))
        .filter(F.col("rate_value").isNotNull())
        .groupBy(p.entity)
        .agg(
            F.avg("rate_value").alias("avg_rate"),
            F.max("rate_value").alias("max_rate"),
            F.min("rate_value").alias("min_rate"),
        )
        .orderBy(F.desc("avg_rate"), p.entity)
    )


def value_range(df: DataFrame, c: str) -> DataFrame:
    """The colour range of a map: 0 to the largest value."""
    return df.agg(F.lit(0).cast("bigint").alias("low"), F.max(c).alias("high"))


def members(p: Panel, c: str, subareas: DataFrame | None = None) -> DataFrame:
    """Distinct values of a column in order, nulls dropped; sub-areas follow their area.

    ``subareas`` is a table (sub_area, area, entity); its sub-areas are listed for the areas
    that occur in the panel.
    """
    base = p.df.select(F.col(c).alias("member")).na.drop().distinct()
    if subareas is None:
        return base.orderBy("member")
    nested = subareas.groupBy(F.col("area").alias("member")).agg(F.collect_set("sub_area").alias("parts"))
    listed = F.concat(F.array("member"), F.coalesce(F.sort_array("parts"), F.array().cast("array<string>")))
    return (
        base.join(nested, "member", "left")
        .select(F.col("member").alias("under"), F.posexplode(listed).alias("place", "member"))
        .orderBy("under", "place")
        .select("member")
    )


def months(p: Panel) -> DataFrame:
    """The months that occur, in order."""
    starts = p.df.select(F.trunc(p.date, "month").alias("start")).na.drop().distinct()
    return starts.select(month_label("start").alias("member")).orderBy("member")


def labelled_totals(p: Panel, measure: str | None = None) -> DataFrame:
    """Total per entity with its cleaned name, null entities dropped."""
    measure = measure or p.cases
    grouped = totals(p, p.entity, [measure], drop_null_keys=True)
    return grouped.withColumn("label", clean_name(p.entity))
