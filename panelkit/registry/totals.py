"""Grouped totals, ratios, rates, and top-N reports."""

from pyspark.sql import functions as F

from ..functions.values import relabel
from ..operators.ranking import (
    order_by_category,
    sort_by,
    top_labels,
    top_n,
    top_rate,
    top_rate_stats,
    top_ratio,
)
from ..operators.rows import filter_month
from ..operators.totals import (
    area_comparison,
    area_totals,
    labelled_totals,
    members,
    months,
    rate_per,
    rate_stats,
    ratio,
    totals,
    value_range,
)
from ..sources.warehouse import observations, subarea_table
from . import query
from .sql import CASES, PANEL, SUMS, clean


@query("a1_total_per_entity", PANEL + f"SELECT entity, {CASES} FROM panel GROUP BY entity")
def a1(spark, folder):
    p = observations(spark, folder)
    return totals(p, p.entity, [p.cases])


@query("a2_totals_per_entity", PANEL + f"SELECT entity, {SUMS} FROM panel GROUP BY entity")
def a2(spark, folder):
    p = observations(spark, folder)
    return totals(p, p.entity)


@query(
    "a3_deaths_per_area",
    PANEL + "SELECT area, CAST(sum(deaths) AS BIGINT) AS total_deaths FROM panel GROUP BY area",
)
def a3(spark, folder):
    return area_totals(observations(spark, folder))


@query("a4_area_comparison", PANEL + f"SELECT area, {SUMS} FROM panel GROUP BY area")
def a4(spark, folder):
    return area_comparison(observations(spark, folder))


RATIO = PANEL + f""", grouped AS (SELECT entity, {SUMS} FROM panel GROUP BY entity), ratios AS (
  SELECT *, CASE WHEN total_cases > 0 THEN CAST(total_deaths AS DOUBLE) / total_cases ELSE 0 END AS ratio FROM grouped
)
"""


@query("a5_case_fatality_ratio", RATIO + "SELECT * FROM ratios")
def a5(spark, folder):
    return ratio(observations(spark, folder))


def _rates(keys: str, pop: str, where: str = "true") -> str:
    return PANEL + f""", grouped AS (
      SELECT entity, {pop} AS population, {SUMS} FROM panel WHERE {where} GROUP BY {keys}
    ), rates AS (
      SELECT *,
        CASE WHEN population > 0 THEN CAST(total_cases AS DOUBLE) / population * 100000 ELSE 0 END AS cases_per_100000,
        CASE WHEN population > 0 THEN CAST(total_deaths AS DOUBLE) / population * 100000 ELSE 0 END AS deaths_per_100000
      FROM grouped
    )
    """


@query("a6_rate_per_100k", _rates("entity", "max(pop)") + "SELECT * FROM rates")
def a6(spark, folder):
    return rate_per(observations(spark, folder))


@query("a6_rate_split_by_population", _rates("entity, pop", "pop") + "SELECT * FROM rates")
def a6_split(spark, folder):
    return rate_per(observations(spark, folder), split_by_pop=True)


@query("a6_rate_population_required", _rates("entity", "max(pop)", "pop IS NOT NULL") + "SELECT * FROM rates")
def a6_required(spark, folder):
    return rate_per(observations(spark, folder), require_pop=True)


@query("a7_carried_value", PANEL + "SELECT entity, max(pop) AS population FROM panel GROUP BY entity")
def a7(spark, folder):
    p = observations(spark, folder)
    return rate_per(p).select(p.entity, "population")


STATS = PANEL + """, stats AS (
  SELECT entity, avg(value) AS avg_rate, max(value) AS max_rate, min(value) AS min_rate
  FROM (SELECT entity, try_cast(rate AS DOUBLE) AS value FROM panel) WHERE value IS NOT NULL GROUP BY entity
)
"""


@query("a8_rate_statistics", STATS + "SELECT * FROM stats")
def a8(spark, folder):
    return rate_stats(observations(spark, folder))


@query(
    "a20_value_range",
    PANEL + f"""
    SELECT CAST(0 AS BIGINT) AS low, max(total_cases) AS high
    FROM (SELECT entity, date, {CASES} FROM panel GROUP BY entity, date)""",
)
def a20(spark, folder):
    p = observations(spark, folder)
    return value_range(totals(p, [p.entity, p.date], [p.cases]), "total_cases")


@query(
    "a26_area_members",
    PANEL + """
    SELECT DISTINCT area AS member FROM panel
    UNION SELECT 'AMERICA EVEN' FROM panel WHERE area = 'AMERICA'
    UNION SELECT 'AMERICA ODD' FROM panel WHERE area = 'AMERICA'""",
)
def a26_areas(spark, folder):
    p = observations(spark, folder)
    return members(p, p.area, subarea_table(spark, folder))


@query("a26_entity_members", PANEL + "SELECT DISTINCT entity AS member FROM panel")
def a26_entities(spark, folder):
    p = observations(spark, folder)
    return members(p, p.entity)


@query("a26_month_members", PANEL + "SELECT DISTINCT strftime(date, '%Y-%m') AS member FROM panel")
def a26_months(spark, folder):
    return months(observations(spark, folder))


def _top(n: int) -> str:
    return f"SELECT entity, {SUMS} FROM panel GROUP BY entity ORDER BY total_cases DESC, entity LIMIT {n}"


@query("t1_top_15_entities", PANEL + _top(15))
def t1(spark, folder):
    p = observations(spark, folder)
    return top_n(totals(p, p.entity), "total_cases", 15, p.entity)


@query(
    "t2_top_10_labels",
    PANEL + f"""
    SELECT entity, {clean('entity')} AS label, {CASES} FROM panel GROUP BY entity
    ORDER BY total_cases DESC, entity LIMIT 10""",
)
def t2(spark, folder):
    return top_labels(observations(spark, folder), 10)


@query(
    "t2_top_10_short_labels",
    PANEL + f"""
    SELECT CASE entity WHEN 'NATION_8' THEN 'N8' WHEN 'NATION_13' THEN 'N13' ELSE entity END AS entity, {CASES}
    FROM panel GROUP BY panel.entity ORDER BY total_cases DESC, panel.entity LIMIT 10""",
)
def t2_short(spark, folder):
    p = observations(spark, folder)
    top = top_n(totals(p, p.entity, [p.cases]), "total_cases", 10, p.entity)
    return top.withColumn(p.entity, relabel(p.entity, {"NATION_8": "N8", "NATION_13": "N13"}))


@query(
    "t3_top_20_ratio",
    RATIO + """
    SELECT * FROM ratios WHERE total_cases >= 100 OR NOT EXISTS (SELECT 1 FROM ratios WHERE total_cases >= 100)
    ORDER BY ratio DESC, entity LIMIT 20""",
)
def t3(spark, folder):
    return top_ratio(observations(spark, folder), 20, 100)


@query(
    "t4_top_15_rate",
    _rates("entity", "coalesce(max(pop), 0)") + """
    SELECT entity, population, total_cases, cases_per_100000 FROM rates
    WHERE population >= 1000 OR NOT EXISTS (SELECT 1 FROM rates WHERE population >= 1000)
    ORDER BY cases_per_100000 DESC, entity LIMIT 15""",
)
def t4(spark, folder):
    return top_rate(observations(spark, folder), 15, 1000)


@query("t5_top_20_rate_statistics", STATS + "SELECT * FROM stats ORDER BY avg_rate DESC, entity LIMIT 20")
def t5(spark, folder):
    return top_rate_stats(observations(spark, folder), 20)


@query(
    "t6_top_50_table",
    PANEL + f"""
    SELECT {clean('entity')} AS label, {CASES} FROM panel GROUP BY entity
    ORDER BY total_cases DESC, label LIMIT 50""",
)
def t6(spark, folder):
    table = labelled_totals(observations(spark, folder)).select("label", "total_cases")
    return top_n(table, "total_cases", 50, "label")


@query(
    "t7_sort_by_keys",
    PANEL + f"SELECT area, entity, {SUMS} FROM panel GROUP BY area, entity ORDER BY area, total_deaths DESC, entity",
)
def t7(spark, folder):
    p = observations(spark, folder)
    grouped = totals(p, [p.area, p.entity])
    return sort_by(grouped, [("area", "asc"), ("total_deaths", "desc"), ("entity", "asc")])


@query(
    "t8_top_n_ascending",
    RATIO + "SELECT * FROM ratios WHERE total_cases >= 100 ORDER BY ratio DESC, entity LIMIT 5",
)
def t8(spark, folder):
    return top_ratio(observations(spark, folder), 5, 100, display="asc")


@query(
    "t9_fixed_order",
    PANEL + f"""
    SELECT area, {SUMS} FROM panel GROUP BY area
    ORDER BY CASE area WHEN 'EUROPE' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'AFRICA' THEN 3 ELSE 4 END, area""",
)
def t9(spark, folder):
    p = observations(spark, folder)
    return order_by_category(totals(p, p.area), {"area": ["EUROPE", "ASIA", "AFRICA"]})


@query(
    "f3_month_top",
    PANEL + f"""
    SELECT entity, {SUMS} FROM panel WHERE date >= DATE '1999-02-01' AND date < DATE '1999-03-01'
    GROUP BY entity ORDER BY total_cases DESC, entity LIMIT 10""",
)
def month_top(spark, folder):
    p = filter_month(observations(spark, folder), "1999-02")
    return top_n(totals(p, p.entity), F.col("total_cases"), 10, p.entity)
