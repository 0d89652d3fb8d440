"""Daily map tables under matched entity names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..binding import Panel
from ..operators.names import (
    apply_fixes,
    coverage,
    daily_by_matched,
    daily_names,
    fill_unmatched,
    fuzzy_match,
    unmatched_report,
)
from ..operators.rows import filter_area
from ..session import settled


def with_matches(p: Panel, daily: DataFrame, matches: DataFrame) -> DataFrame:
    """Adds ``match`` to daily sums, from the matches of their names. The sums are joined, not the
    panel rows, and both should be settled.
    """
    found = matches.select("raw", "match")
    return daily.join(found, daily[p.entity] == found["raw"], "left").drop("raw")


def match_names(p: Panel, daily: DataFrame, valid: DataFrame, threshold: float) -> DataFrame:
    """The matches of the distinct names, one row each, made once and written."""
    return settled(fuzzy_match(daily, p.entity, valid, threshold), "matches")


def matched_map(
    p: Panel,
    valid: DataFrame,
    fixes: Mapping[str, str] | DataFrame,
    area: str | None = None,
    threshold: float = 95.0,
) -> dict[str, DataFrame]:
    """``map``: cases per date and matched name; ``coverage``: percent of rows matched;
    ``unmatched``: the names without a match and what they are closest to.

    For the whole world the corrections are made before matching, and unmatched names are left
    out. For one area they are made after it, and unmatched names are kept under their raw name.
    """
    daily = settled(daily_names(filter_area(p, area)), "daily")
    if area is None:
        daily = apply_fixes(daily, p.entity, fixes)
    matches = match_names(p, daily, valid, threshold)
    joined = with_matches(p, daily, matches)
    shown = joined if area is None else fill_unmatched(joined, "match", p.entity, fixes)
    return {
        "map": daily_by_matched(p, shown),
        "coverage": coverage(shown, rows="rows"),
        "unmatched": unmatched_report(matches, valid),
    }
