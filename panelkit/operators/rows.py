"""Row and column operators: projection, renaming, filters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..binding import Panel
from ..constants import SUBAREA_PARENT
from ..functions.values import number_in

ALL = "All"


def select_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def filter_area(
    p: Panel,
    area: str | None,
    subareas: Mapping[str, list[str]] | DataFrame | None = None,
    parent: str = SUBAREA_PARENT,
) -> Panel:
    """Rows of one area, or of one sub-area of ``parent``; None keeps all rows.

    Sub-areas are a mapping from name to entities, or a table (sub_area, area, entity) for lists
    too long to write out. A choice that is no sub-area is an area. With a table this is settled
    while the query runs, by a filter on the area that is pushed down like any other, and a join
    with the members, if there are any.
    """
    if not area:
        return p
    if isinstance(subareas, DataFrame):
        chosen = subareas.filter(F.col("sub_area") == area)
        members = chosen.select(F.col("area").alias("_area"), F.col("entity").alias("_entity")).distinct()
        areas = one_value(members, F.collect_set("_area"))
        inside = p.df.where(F.array_contains(F.when(F.size(areas) > 0, areas).otherwise(F.array(F.lit(area))), p.df[p.area]))
        joined = inside.join(members, (inside[p.area] == F.col("_area")) & (inside[p.entity] == F.col("_entity")), "left")
        return p.using(joined.where(F.col("_area").isNotNull() | (F.size(areas) == 0)).select(*p.df.columns))
    if subareas and area in subareas:
        return p.where((F.col(p.area) == parent) & F.col(p.entity).isin(list(subareas[area])))
    return p.where(F.col(p.area) == area)


def filter_month(p: Panel, month: str | None) -> Panel:
    """Rows of the month ``yyyy-MM``. Compares dates, so the filter reaches the scan."""
    if month in (None, ALL):
        return p
    year, number = (int(x) for x in month.split("-"))
    start = date(year, number, 1)
    end = date(year + number // 12, number % 12 + 1, 1)
    return p.where((F.col(p.date) >= F.lit(start)) & (F.col(p.date) < F.lit(end)))


def filter_entity(p: Panel, entity: str | None) -> Panel:
    if entity in (None, ALL):
        return p
    return p.where(F.col(p.entity) == entity)


def apply_filters(
    p: Panel,
    area: str | None = None,
    month: str | None = None,
    entity: str | None = None,
    subareas: Mapping[str, list[str]] | DataFrame | None = None,
) -> Panel:
    """The cascade area, then month, then entity."""
    return filter_entity(filter_month(filter_area(p, area, subareas), month), entity)


def row_count(p: Panel) -> DataFrame:
    return p.df.agg(F.count("*").alias("rows"))


def drop_unparsable(p: Panel, c: str, dtype: str = "double") -> Panel:
    """Convert a dirty column and keep the rows where that worked."""
    return p.using(p.df.withColumn(c, number_in(p.df, c, dtype))).where(F.col(c).isNotNull())


def require_cols(p: Panel, cols: list[str]) -> Panel:
    """Drop rows where any of the columns is null or, for text, blank."""
    types = dict(p.df.dtypes)
    for c in cols:
        present = F.col(c).isNotNull()
        p = p.where(present & (F.col(c) != "") if types[c] == "string" else present)
    return p


def strict_rows(p: Panel) -> Panel:
    """Drop rows of a typed panel whose date or any measure did not parse."""
    return p.using(p.df.na.drop(subset=[p.date, *p.measures]))


def one_value(df: DataFrame, value: Column) -> Column:
    """An aggregate over all rows as a scalar subquery, in a form that needs every column of
    ``df``. So where ``df`` is an aggregation, the query and its subquery share one scan and one
    shuffle instead of pruning the subquery's to a different one.
    """
    whole_row = F.max(F.struct(*df.columns)).alias("whole_row")
    return df.agg(F.struct(value.alias("value"), whole_row).alias("s")).select("s").scalar()["value"]


def min_threshold(df: DataFrame, c: str, minimum: float) -> DataFrame:
    """Rows with ``c >= minimum``; all rows if none qualifies. Nothing is run to find out which."""
    any_qualifies = F.coalesce(one_value(df, F.max(F.col(c) >= minimum)), F.lit(False))
    return df.filter((F.col(c) >= minimum) | ~any_qualifies)


def drop_unmapped(df: DataFrame, code: str = "iso_a3") -> DataFrame:
    return df.filter(F.col(code).isNotNull())


def list_unmapped(df: DataFrame, name: str, code: str = "iso_a3") -> DataFrame:
    return df.filter(F.col(code).isNull()).select(name).distinct()
