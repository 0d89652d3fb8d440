"""The tables behind the dashboard and the animated map."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..binding import Panel
from ..constants import CODE_ALIASES
from ..functions.calendar import bucket_label
from ..operators.names import iso3
from ..operators.ranking import top_n
from ..operators.rows import ALL, apply_filters, drop_unmapped
from ..operators.totals import labelled_totals, totals
from ..session import settled
from ..operators.trends import daily_series, daily_totals, month_snapshot, monthly_by_entity


def dashboard(
    p: Panel,
    dim: DataFrame,
    area: str | None = None,
    month: str | None = None,
    entity: str | None = None,
    subareas: Mapping[str, list[str]] | DataFrame | None = None,
    aliases: Mapping[str, str] = CODE_ALIASES,
    snapshot: str | None = None,
) -> dict[str, DataFrame]:
    """All tables of the dashboard for one choice of filters.

    Everything is derived from the filtered panel summed per entity and day, which has at most
    one row per entity and day and is written once. ``series`` is present only while no month is chosen.
    """
    chosen = apply_filters(p, area, month, entity, subareas)
    keys = [p.entity, p.date]
    daily = totals(chosen, keys).withColumnsRenamed({f"total_{m}": m for m in p.measures})
    base = p.using(settled(daily, "dashboard"))

    total = f"total_{p.cases}"
    labelled = labelled_totals(base).select(p.entity, "label", total)
    table = labelled.select("label", total)
    tables = {
        "cases": labelled,
        "deaths": totals(base, p.entity, [p.deaths], drop_null_keys=True),
        "top10": top_n(labelled, total, 10, p.entity),
        "top50": top_n(table, total, 50, "label"),
        "map": drop_unmapped(iso3(table, "label", dim, aliases)),
        "map_by_month": drop_unmapped(iso3(monthly_by_entity(base), "label", dim, aliases)),
        "map_snapshot": drop_unmapped(iso3(month_snapshot(base, snapshot), "label", dim, aliases)),
    }
    if month in (None, ALL):
        tables["series"] = daily_series(base)
    return tables


def map_frames(p: Panel) -> DataFrame:
    """Daily totals per entity with the frame label and the colour range of all frames."""
    total = f"total_{p.cases}"
    daily = daily_totals(p).select(p.entity, p.date, total)
    return daily.withColumns(
        {
            "frame": bucket_label(p.date, "day"),
            "range_low": F.lit(0).cast("bigint"),
            "range_high": daily.agg(F.max(total)).scalar(),
        }
    ).orderBy(p.date, p.entity)
