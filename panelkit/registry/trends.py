"""Trends per day, week and month, running totals, matched daily totals."""

from pyspark.sql import functions as F

from ..functions.calendar import bucket_label
from ..operators.names import coverage, daily_by_matched, daily_names
from ..operators.running import cumulative, cumulative_final, cumulative_records
from ..operators.trends import (
    daily_record_counts,
    daily_series,
    daily_totals,
    month_snapshot,
    monthly_by_entity,
    multi_trend,
    trend,
)
from ..plans.matched import match_names, with_matches
from ..session import settled
from ..sources.warehouse import messy_observations, observations, territory_dimension
from . import query
from .sql import CASES, PANEL, SUMS, clean, matches

DAY = "CAST(date AS VARCHAR) AS date"
YEAR, MONTH = "CAST(year(date) AS INTEGER) AS year", "CAST(month(date) AS INTEGER) AS month"
WEEK = "CAST(week(date) AS INTEGER) AS week"


@query("a9_daily_totals", PANEL + f"SELECT entity, {DAY}, {SUMS} FROM panel GROUP BY entity, panel.date")
def a9(spark, folder):
    return daily_totals(observations(spark, folder))


@query(
    "a10_weekly_trend",
    PANEL + f"SELECT entity, CAST(isoyear(date) AS INTEGER) AS year, {WEEK}, {SUMS} FROM panel GROUP BY 1, 2, 3",
)
def a10(spark, folder):
    p = observations(spark, folder)
    return trend(p, "week", p.entity)


@query(
    "a10_weekly_trend_calendar_year",
    PANEL + f"SELECT entity, {YEAR}, {WEEK}, {SUMS} FROM panel GROUP BY 1, 2, 3",
)
def a10_calendar(spark, folder):
    p = observations(spark, folder)
    return trend(p, "week", p.entity, week_year="calendar")


@query("a11_monthly_trend", PANEL + f"SELECT entity, {YEAR}, {MONTH}, {SUMS} FROM panel GROUP BY 1, 2, 3")
def a11(spark, folder):
    p = observations(spark, folder)
    return trend(p, "month", p.entity)


@query(
    "a12_multi_trend",
    PANEL + f""", tagged AS (
      SELECT entity, 'day' AS level, strftime(date, '%Y-%m-%d') AS bucket, cases, deaths FROM panel
      UNION ALL
      SELECT entity, 'week', printf('%04d-W%02d', isoyear(date), week(date)), cases, deaths FROM panel
      UNION ALL
      SELECT entity, 'month', strftime(date, '%Y-%m'), cases, deaths FROM panel
    )
    SELECT entity, level, bucket, {SUMS} FROM tagged GROUP BY 1, 2, 3""",
)
def a12(spark, folder):
    return multi_trend(observations(spark, folder))


@query("a13_global_monthly_trend", PANEL + f"SELECT {YEAR}, {MONTH}, {SUMS} FROM panel GROUP BY 1, 2")
def a13(spark, folder):
    return trend(observations(spark, folder), "month")


@query(
    "a14_monthly_by_label",
    PANEL + f"SELECT strftime(date, '%Y-%m') AS month, {clean('entity')} AS label, {CASES} FROM panel GROUP BY 1, 2",
)
def a14(spark, folder):
    return monthly_by_entity(observations(spark, folder))


@query(
    "a15_latest_month",
    PANEL + f"""
    SELECT strftime(date, '%Y-%m') AS month, {clean('entity')} AS label, {CASES} FROM panel
    WHERE strftime(date, '%Y-%m') = (SELECT max(strftime(date, '%Y-%m')) FROM panel) GROUP BY 1, 2""",
)
def a15(spark, folder):
    return month_snapshot(observations(spark, folder))


@query(
    "a15_chosen_month",
    PANEL + f"""
    SELECT '1996-02' AS month, {clean('entity')} AS label, {CASES} FROM panel
    WHERE date >= DATE '1996-02-01' AND date < DATE '1996-03-01' GROUP BY 1, 2""",
)
def a15_chosen(spark, folder):
    return month_snapshot(observations(spark, folder), "1996-02")


@query("a16_daily_series", PANEL + f"SELECT {DAY}, {CASES} FROM panel GROUP BY panel.date")
def a16(spark, folder):
    return daily_series(observations(spark, folder))


@query("a17_daily_record_counts", PANEL + f"SELECT {DAY}, count(*) AS record_count FROM panel GROUP BY panel.date")
def a17(spark, folder):
    return daily_record_counts(observations(spark, folder))


THRESHOLD = 85.0
MATCHED = PANEL + "," + matches("SELECT DISTINCT spelled AS raw FROM panel", THRESHOLD)


def _matched_daily(spark, folder):
    p = messy_observations(spark, folder)
    valid = territory_dimension(spark, folder).select("name")
    daily = settled(daily_names(p), "daily")
    return p, with_matches(p, daily, match_names(p, daily, valid, THRESHOLD))


@query(
    "a18_daily_by_matched_name",
    MATCHED + f"""
    SELECT {DAY}, match, {CASES} FROM panel JOIN best ON spelled = raw
    WHERE match IS NOT NULL GROUP BY panel.date, match""",
)
def a18(spark, folder):
    return daily_by_matched(*_matched_daily(spark, folder))


@query(
    "a19_match_coverage",
    MATCHED + """
    SELECT count(match) * CAST(100 AS DOUBLE) / count(*) AS coverage FROM panel LEFT JOIN best ON spelled = raw""",
)
def a19(spark, folder):
    return coverage(_matched_daily(spark, folder)[1], rows="rows")


def _running(by: str) -> str:
    over = f"OVER (PARTITION BY {by} ORDER BY date ROWS UNBOUNDED PRECEDING)"
    return PANEL + f""", daily AS (SELECT {by}, date, {SUMS} FROM panel GROUP BY {by}, date)
    SELECT {by}, {DAY}, total_cases, total_deaths,
           CAST(sum(total_cases) {over} AS BIGINT) AS cumulative_cases,
           CAST(sum(total_deaths) {over} AS BIGINT) AS cumulative_deaths
    FROM daily"""


@query("w1_running_by_entity", _running("entity"))
def w1(spark, folder):
    return cumulative(observations(spark, folder))


@query("w2_running_by_area", _running("area"))
def w2(spark, folder):
    p = observations(spark, folder)
    return cumulative(p, p.area)


@query(
    "w2_running_records_by_area",
    PANEL + f""", records AS (SELECT area, date, entity, {SUMS} FROM panel GROUP BY area, date, entity)
    SELECT area, {DAY}, entity, total_cases, total_deaths,
           CAST(sum(total_cases) OVER w AS BIGINT) AS cumulative_cases,
           CAST(sum(total_deaths) OVER w AS BIGINT) AS cumulative_deaths
    FROM records WINDOW w AS (PARTITION BY area ORDER BY records.date, entity ROWS UNBOUNDED PRECEDING)""",
)
def w2_records(spark, folder):
    return cumulative_records(observations(spark, folder))


@query(
    "w3_final_running_total",
    PANEL + """
    SELECT entity, CAST(max(date) AS VARCHAR) AS last_date, CAST(sum(cases) AS BIGINT) AS cumulative_cases,
           CAST(sum(deaths) AS BIGINT) AS cumulative_deaths FROM panel GROUP BY entity""",
)
def w3(spark, folder):
    return cumulative_final(observations(spark, folder))


@query(
    "a9_daily_labels",
    PANEL + f"SELECT strftime(date, '%Y-%m-%d') AS label, {SUMS} FROM panel GROUP BY 1",
)
def daily_labels(spark, folder):
    p = observations(spark, folder)
    return trend(p, "day").select(bucket_label(p.date, "day").alias("label"), F.col("total_cases"), F.col("total_deaths"))
