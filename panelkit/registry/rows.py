"""Projections and filters."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.calendar import iso_week, year_of
from ..functions.values import to_number
from ..operators.names import iso3
from ..operators.rows import (
    apply_filters,
    derive,
    drop_unmapped,
    drop_unparsable,
    filter_area,
    filter_entity,
    filter_month,
    list_unmapped,
    min_threshold,
    rename,
    require_cols,
    row_count,
    select_cols,
    strict_rows,
)
from ..operators.runstats import suspect_runs
from ..operators.totals import totals
from ..operators.trends import daily_totals, trend
from ..sources.panel_csv import typed_panel
from ..sources.warehouse import (
    messy_observations,
    observations,
    run_results,
    subarea_table,
    territory_dimension,
)
from . import query
from .sql import CASES, NATION_CODES, PANEL, RUNS, SUMS, clean


@query("p1_select_columns", PANEL + "SELECT CAST(date AS VARCHAR) AS date, cases, entity, area FROM panel")
def p1(spark, folder):
    return select_cols(observations(spark, folder).df, "date", "cases", "entity", "area")


@query(
    "p2_rename_columns",
    PANEL + """
    SELECT entity AS country, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(sum(cases) AS BIGINT) AS monthly_cases, CAST(sum(deaths) AS BIGINT) AS monthly_deaths
    FROM panel GROUP BY 1, 2, 3""",
)
def p2(spark, folder):
    p = observations(spark, folder)
    names = {"entity": "country", "total_cases": "monthly_cases", "total_deaths": "monthly_deaths"}
    return rename(trend(p, "month", p.entity), names)


@query(
    "p3_derived_columns",
    PANEL + """
    SELECT CAST(year(date) AS INTEGER) AS year, CAST(week(date) AS INTEGER) AS week, count(*) AS rows,
           sum(try_cast(rate AS DOUBLE)) AS incidence
    FROM panel GROUP BY 1, 2""",
)
def p3(spark, folder):
    p = observations(spark, folder)
    df = derive(
        p.df, incidence=to_number(p.rate, "double"), week=iso_week(p.date), year=year_of(p.date)
    )
    return df.groupBy("year", "week").agg(F.count("*").alias("rows"), F.sum("incidence").alias("incidence"))


@query("f1_filter_area", PANEL + f"SELECT entity, {SUMS} FROM panel WHERE area = 'EUROPE' GROUP BY entity")
def f1(spark, folder):
    p = filter_area(observations(spark, folder), "EUROPE")
    return totals(p, p.entity)


@query(
    "f2_filter_subarea",
    PANEL + f"""
    SELECT entity, {SUMS} FROM panel
    WHERE area = 'AMERICA' AND entity IN (SELECT n_name FROM nation WHERE n_nationkey % 2 = 1)
    GROUP BY entity""",
)
def f2(spark, folder):
    p = filter_area(observations(spark, folder), "AMERICA ODD", subarea_table(spark, folder))
    return totals(p, p.entity)


@query("f2_filter_area_beside_subareas", PANEL + f"SELECT entity, {SUMS} FROM panel WHERE area = 'EUROPE' GROUP BY entity")
def f2_area(spark, folder):
    p = filter_area(observations(spark, folder), "EUROPE", subarea_table(spark, folder))
    return totals(p, p.entity)


@query(
    "f2_choices",
    PANEL + """
    SELECT 'AMERICA' AS choice, count(*) AS rows FROM panel WHERE area = 'AMERICA'
    UNION ALL SELECT 'ASIA', count(*) FROM panel WHERE area = 'ASIA'
    UNION ALL SELECT 'AMERICA EVEN', count(*) FROM panel JOIN nation ON entity = n_name WHERE area = 'AMERICA' AND n_nationkey % 2 = 0
    UNION ALL SELECT 'AMERICA ODD', count(*) FROM panel JOIN nation ON entity = n_name WHERE area = 'AMERICA' AND n_nationkey % 2 = 1""",
)
def f2_choices(spark, folder):
    """Areas and sub-areas are offered side by side, and each choice gives its rows."""
    p, subareas = observations(spark, folder), subarea_table(spark, folder)
    chosen = ["AMERICA", "AMERICA EVEN", "AMERICA ODD", "ASIA"]
    counts = [row_count(filter_area(p, c, subareas)).select(F.lit(c).alias("choice"), "rows") for c in chosen]
    return reduce(lambda a, b: a.union(b), counts)


@query(
    "f5_filter_cascade_beside_subareas",
    PANEL + """
    SELECT count(*) AS rows FROM panel
    WHERE area = 'EUROPE' AND date >= DATE '1997-05-01' AND date < DATE '1997-06-01'""",
)
def f5_area(spark, folder):
    return row_count(apply_filters(observations(spark, folder), "EUROPE", "1997-05", None, subarea_table(spark, folder)))


@query(
    "f3_filter_month",
    PANEL + f"SELECT entity, {SUMS} FROM panel WHERE strftime(date, '%Y-%m') = '1998-12' GROUP BY entity",
)
def f3(spark, folder):
    p = filter_month(observations(spark, folder), "1998-12")
    return totals(p, p.entity)


@query(
    "f4_filter_entity",
    PANEL + f"""
    SELECT entity, CAST(date AS VARCHAR) AS date, {SUMS} FROM panel WHERE entity = 'NATION_8' GROUP BY entity, date""",
)
def f4(spark, folder):
    return daily_totals(filter_entity(observations(spark, folder), "NATION_8"))


@query(
    "f5_filter_cascade",
    PANEL + """
    SELECT count(*) AS rows FROM panel
    WHERE area = 'EUROPE' AND date >= DATE '1997-05-01' AND date < DATE '1997-06-01' AND entity = 'NATION_8'""",
)
def f5(spark, folder):
    return row_count(apply_filters(observations(spark, folder), "EUROPE", "1997-05", "NATION_8"))


@query(
    "f6_drop_unparsable",
    PANEL + """
    SELECT entity, count(*) AS rows, sum(try_cast(rate AS DOUBLE)) AS rate
    FROM panel WHERE try_cast(rate AS DOUBLE) IS NOT NULL GROUP BY entity""",
)
def f6(spark, folder):
    p = observations(spark, folder)
    kept = drop_unparsable(p, p.rate)
    return kept.df.groupBy(p.entity).agg(F.count("*").alias("rows"), F.sum(p.rate).alias("rate"))


@query(
    "f7_require_columns",
    PANEL + f"SELECT entity, {SUMS} FROM panel WHERE rate <> '' AND pop IS NOT NULL GROUP BY entity",
)
def f7(spark, folder):
    p = observations(spark, folder)
    return totals(require_cols(p, [p.cases, p.deaths, p.pop, p.rate]), p.entity)


@query(
    "f8_strict_rows",
    PANEL + """
    SELECT entity, CAST(sum(CAST(rate AS BIGINT)) AS BIGINT) AS total_rate, CAST(sum(deaths) AS BIGINT) AS total_deaths
    FROM panel WHERE rate <> '' GROUP BY entity""",
)
def f8(spark, folder):
    p = observations(spark, folder)
    dirty = typed_panel(p.using(p.df.drop(p.cases), cases=p.rate))
    return totals(strict_rows(dirty), p.entity)


@query(
    "f9_min_threshold",
    PANEL + f""", grouped AS (SELECT entity, {CASES} FROM panel GROUP BY entity)
    SELECT 'strict' AS kind, * FROM grouped
    WHERE total_cases >= 50000 OR NOT EXISTS (SELECT 1 FROM grouped WHERE total_cases >= 50000)
    UNION ALL SELECT 'relaxed', * FROM grouped""",
)
def f9(spark, folder):
    p = observations(spark, folder)
    grouped = totals(p, p.entity, [p.cases])
    strict = min_threshold(grouped, "total_cases", 50_000).withColumn("kind", F.lit("strict"))
    out_of_reach = min_threshold(grouped, "total_cases", 10**18).withColumn("kind", F.lit("relaxed"))
    return strict.unionByName(out_of_reach)


CODED = PANEL + f""", {NATION_CODES}, coded AS (
  SELECT spelled, total_cases, coalesce(a.alpha_3, b.alpha_3) AS iso_a3
  FROM (SELECT spelled, {CASES} FROM panel GROUP BY spelled)
  LEFT JOIN forms a ON a.form = lower({clean('spelled')})
  LEFT JOIN forms b ON b.form = lower(trim(regexp_replace({clean('spelled')}, '\\s*\\(.*\\)', '')))
)
"""


def _coded(spark, folder):
    p = messy_observations(spark, folder)
    return iso3(totals(p, p.entity, [p.cases]), p.entity, territory_dimension(spark, folder))


@query("f10_drop_unmapped", CODED + "SELECT * FROM coded WHERE iso_a3 IS NOT NULL")
def f10(spark, folder):
    return drop_unmapped(_coded(spark, folder))


@query("f10_list_unmapped", CODED + "SELECT DISTINCT spelled FROM coded WHERE iso_a3 IS NULL")
def f10_list(spark, folder):
    return list_unmapped(_coded(spark, folder), "spelled")


@query(
    "f11_suspect_runs",
    RUNS + "SELECT framework, workload, runid, wall_time_sec, logfile FROM runs WHERE wall_time_sec <= 0.5",
)
def f11(spark, folder):
    return suspect_runs(run_results(spark, folder), 0.5)
