"""Jobs from a panel CSV to a written report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.ranking import top_n, top_ratio
from ..operators.totals import totals
from ..operators.trends import trend
from ..sources.panel_csv import read_panel
from ..sources.tables import write_csv


def top_countries_job(spark: SparkSession, path: str, out: str, n: int = 15) -> DataFrame:
    """The entities with most cases."""
    p = read_panel(spark, path)
    return write_csv(top_n(totals(p, p.entity), f"total_{p.cases}", n, p.entity), out)


def ratio_job(spark: SparkSession, path: str, out: str, n: int = 20, min_cases: int = 100) -> DataFrame:
    """The entities with the highest share of deaths among their cases."""
    return write_csv(top_ratio(read_panel(spark, path), n, min_cases), out)


def monthly_job(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Totals per month over all entities."""
    return write_csv(trend(read_panel(spark, path), "month"), out)
