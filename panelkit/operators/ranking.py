"""Top-N reports and fixed display orders. Ties are broken by the entity name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..binding import Panel
from .rows import min_threshold
from .totals import labelled_totals, rate_per, rate_stats, ratio


def top_n(df: DataFrame, c: str, n: int, tie: str, display: str = "desc") -> DataFrame:
    """The n largest rows by ``c``; ``display="asc"`` shows those n rows smallest first."""
    top = df.orderBy(F.desc(c), F.asc(tie)).limit(n)
    if display == "asc":
        return top.orderBy(F.asc(c), F.desc(tie))
    return top


def top_labels(p: Panel, n: int = 10) -> DataFrame:
    """The entities with most cases, under their cleaned names."""
    totals = labelled_totals(p).select(p.entity, "label", f"total_{p.cases}")
    return top_n(totals, f"total_{p.cases}", n, p.entity)


def top_ratio(p: Panel, n: int = 20, min_cases: int = 100, display: str = "desc") -> DataFrame:
    kept = min_threshold(ratio(p), f"total_{p.cases}", min_cases)
    return top_n(kept, "ratio", n, p.entity, display)


def top_rate(p: Panel, n: int = 15, min_pop: int = 1000, per: int = 100_000) -> DataFrame:
    rates = rate_per(p, [p.cases], per).na.fill(0, subset=["population"])
    return top_n(min_threshold(rates, "population", min_pop), f"{p.cases}_per_{per}", n, p.entity)


def top_rate_stats(p: Panel, n: int = 20) -> DataFrame:
    stats = rate_stats(p).na.fill(0.0, subset=["avg_rate", "max_rate", "min_rate"])
    return top_n(stats, "avg_rate", n, p.entity)


def sort_by(df: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort by ``(column, "asc" | "desc")`` pairs."""
    return df.orderBy(*[F.desc(c) if way == "desc" else F.asc(c) for c, way in keys])


def order_by_category(df: DataFrame, categories: dict[str, Sequence[str]]) -> DataFrame:
    """Sort columns by the place of their value in a list; values outside the list come last."""
    order = []
    for c, listed in categories.items():
        place = F.array_position(F.array(*[F.lit(v) for v in listed]), F.col(c))
        order += [F.when(place > 0, place).asc_nulls_last(), F.col(c).asc_nulls_last()]
    return df.orderBy(*order)
