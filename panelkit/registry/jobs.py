"""Composite jobs."""

from functools import reduce

from pyspark.sql import functions as F

from ..plans.dashboard import dashboard, map_frames
from ..plans.matched import matched_map
from ..plans.reports import monthly_job, ratio_job, top_countries_job
from ..plans.rollup import rollup
from ..plans.runlog import run_log_job
from ..session import fresh_path
from ..sources.warehouse import (
    messy_observations,
    observation_csv,
    observations,
    once,
    run_log_files,
    spelling_fixes,
    subarea_table,
    territory_dimension,
)
from . import query
from .names import FIXES
from .sql import CASES, LOG_FILES, NATION_CODES, PANEL, SUMS, clean, matches
from .totals import RATIO
from .trends import DAY, THRESHOLD

# The written reports carry the column names of the CSV.
CSV_ENTITY = "countriesAndTerritories"


@query(
    "c1_run_log_job",
    LOG_FILES + """
    SELECT framework, workload, CAST(week AS VARCHAR) AS runid, CAST(events AS DOUBLE) / 100 AS wall_time_sec,
           rss AS max_rss_kb, framework || '_' || workload || '_run' || week || '_data.time.txt' AS logfile
    FROM logs""",
)
def c1(spark, folder):
    results = run_log_job(spark, run_log_files(spark, folder), fresh_path(spark, "results"))
    return results.withColumn("wall_time_sec", F.round("wall_time_sec", 2))


@query(
    "c2_top_report",
    PANEL + f"""
    SELECT entity AS "{CSV_ENTITY}", {SUMS} FROM panel GROUP BY entity ORDER BY total_cases DESC, entity LIMIT 15""",
)
def c2(spark, folder):
    return top_countries_job(spark, observation_csv(spark, folder), fresh_path(spark, "report"))


@query(
    "c3_ratio_report",
    RATIO + f"""
    SELECT entity AS "{CSV_ENTITY}", total_cases, total_deaths, ratio FROM ratios
    WHERE total_cases >= 100 OR NOT EXISTS (SELECT 1 FROM ratios WHERE total_cases >= 100)
    ORDER BY ratio DESC, entity LIMIT 20""",
)
def c3(spark, folder):
    return ratio_job(spark, observation_csv(spark, folder), fresh_path(spark, "report"))


@query(
    "c4_monthly_report",
    PANEL + f"""
    SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {SUMS} FROM panel GROUP BY 1, 2""",
)
def c4(spark, folder):
    return monthly_job(spark, observation_csv(spark, folder), fresh_path(spark, "report"))


def _long(tables, keys):
    """The tables of a job in one: which table, key, value."""
    parts = [
        tables[name].select(
            F.lit(name).alias("part"), F.col(key).cast("string").alias("key"), F.col(value).alias("value")
        )
        for name, (key, value) in keys.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _dashboard_sql(condition: str) -> str:
    return PANEL + f""", {NATION_CODES}, chosen AS (
      SELECT * FROM panel WHERE {condition}
    ), cases AS (SELECT entity, {clean('entity')} AS label, {CASES} FROM chosen GROUP BY entity
    ), monthly AS (
      SELECT strftime(date, '%Y-%m') AS month, {clean('entity')} AS label, {CASES} FROM chosen GROUP BY 1, 2
    ), snapshot AS (SELECT * FROM monthly WHERE month = (SELECT max(month) FROM monthly))
    SELECT 'cases' AS part, entity AS key, total_cases AS value FROM cases
    UNION ALL SELECT 'deaths', entity, CAST(sum(deaths) AS BIGINT) FROM chosen GROUP BY entity
    UNION ALL (SELECT 'top10', label, total_cases FROM cases ORDER BY total_cases DESC, entity LIMIT 10)
    UNION ALL (SELECT 'top50', label, total_cases FROM cases ORDER BY total_cases DESC, label LIMIT 50)
    UNION ALL SELECT 'map', alpha_3, total_cases FROM cases JOIN forms ON form = lower(label)
    UNION ALL SELECT 'map_by_month', alpha_3, total_cases FROM monthly JOIN forms ON form = lower(label)
    UNION ALL SELECT 'map_snapshot', alpha_3, total_cases FROM snapshot JOIN forms ON form = lower(label)
    UNION ALL SELECT 'series', CAST(date AS VARCHAR), {CASES.split(' AS total')[0]} FROM chosen GROUP BY date"""


def _sums(spark, folder):
    """The panel's rollup, which all choices of this application share while the tables' files stay as they are."""
    home = once(spark, folder, "rollup", lambda: fresh_path(spark, "rollups"))
    return rollup(spark, home, [folder], lambda _: observations(spark, folder))


def _dashboard(spark, folder, area):
    tables = dashboard(
        _sums(spark, folder), territory_dimension(spark, folder), area=area, subareas=subarea_table(spark, folder)
    )
    total = "total_cases"
    return _long(
        tables,
        {
            "cases": ("entity", total),
            "deaths": ("entity", "total_deaths"),
            "top10": ("label", total),
            "top50": ("label", total),
            "map": ("iso_a3", total),
            "map_by_month": ("iso_a3", total),
            "map_snapshot": ("iso_a3", total),
            "series": ("date", total),
        },
    )


@query(
    "c5_dashboard",
    _dashboard_sql("area = 'AMERICA' AND entity IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 1)"),
)
def c5(spark, folder):
    return _dashboard(spark, folder, "AMERICA ODD")


@query("c5_dashboard_of_area", _dashboard_sql("area = 'EUROPE'"))
def c5_area(spark, folder):
    return _dashboard(spark, folder, "EUROPE")


IN_WORLD = PANEL + f""", {FIXES}, fixed_panel AS (
  SELECT panel.date, coalesce(fixed, spelled) AS name, cases FROM panel LEFT JOIN fixes ON spelled = raw
), {matches("SELECT DISTINCT name AS raw FROM fixed_panel", THRESHOLD)}
"""


def _world_map(spark, folder):
    valid = territory_dimension(spark, folder).select("name")
    return matched_map(messy_observations(spark, folder), valid, spelling_fixes(spark, folder), threshold=THRESHOLD)


@query(
    "c6_matched_map_world",
    IN_WORLD + f"""
    SELECT {DAY}, match, {CASES} FROM fixed_panel JOIN best ON name = raw
    WHERE match IS NOT NULL GROUP BY fixed_panel.date, match""",
)
def c6_world(spark, folder):
    return _world_map(spark, folder)["map"]


@query(
    "c6_coverage_world",
    IN_WORLD + "SELECT count(match) * CAST(100 AS DOUBLE) / count(*) AS coverage FROM fixed_panel LEFT JOIN best ON name = raw",
)
def c6_coverage(spark, folder):
    return _world_map(spark, folder)["coverage"]


@query("c6_unmatched_world", IN_WORLD + "SELECT raw, clean, closest, score FROM best WHERE match IS NULL")
def c6_unmatched_world(spark, folder):
    return _world_map(spark, folder)["unmatched"]


IN_EUROPE = PANEL + f""", {FIXES}, europe AS (SELECT * FROM panel WHERE area = 'EUROPE'),
{matches("SELECT DISTINCT spelled AS raw FROM europe", THRESHOLD)}
"""


@query(
    "c6_matched_map_area",
    IN_EUROPE + f""", shown AS (
      SELECT europe.date, coalesce(match, fixed, spelled) AS match, cases
      FROM europe JOIN best ON spelled = best.raw LEFT JOIN fixes ON spelled = fixes.raw
    )
    SELECT {DAY}, match, {CASES} FROM shown GROUP BY shown.date, match""",
)
def c6_area(spark, folder):
    valid = territory_dimension(spark, folder).select("name")
    p = messy_observations(spark, folder)
    return matched_map(p, valid, spelling_fixes(spark, folder), "EUROPE", THRESHOLD)["map"]


@query(
    "c6_unmatched_in_area",
    IN_EUROPE + "SELECT raw, clean, closest, score FROM best WHERE match IS NULL",
)
def c6_unmatched(spark, folder):
    valid = territory_dimension(spark, folder).select("name")
    p = messy_observations(spark, folder)
    return matched_map(p, valid, spelling_fixes(spark, folder), "EUROPE", THRESHOLD)["unmatched"]


@query(
    "c7_map_frames",
    PANEL + f""", daily AS (SELECT entity, date, {CASES} FROM panel GROUP BY entity, date)
    SELECT entity, {DAY}, total_cases, strftime(date, '%Y-%m-%d') AS frame, CAST(0 AS BIGINT) AS range_low,
           (SELECT max(total_cases) FROM daily) AS range_high FROM daily""",
)
def c7(spark, folder):
    return map_frames(observations(spark, folder))
