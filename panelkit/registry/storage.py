"""Sources and sinks."""

from pyspark.sql import functions as F

from ..functions.runtext import max_rss_kb
from ..functions.values import fmt_number
from ..operators.ranking import top_n
from ..operators.totals import ratio, totals
from ..operators.trends import trend
from ..session import fresh_path
from ..sources.panel_csv import read_panel
from ..sources.runs import read_results, read_run_logs
from ..sources.tables import (
    load_table,
    show_rows,
    summarize_result,
    write_csv,
    write_json,
    write_one_csv,
    write_table,
    write_tsv,
)
from ..sources.warehouse import observation_csv, observations, run_log_files, run_result_csv
from . import query
from .sql import CASES, LOG_FILES, PANEL, RUNS, SUMS

SCAN_SQL = """
SELECT {key}, count(*) AS rows, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
       count(try_cast(rate AS DOUBLE)) AS rates, CAST(min(date) AS VARCHAR) AS first, CAST(max(date) AS VARCHAR) AS last
FROM panel GROUP BY {key}
"""


def _scan(p, key, name):
    """What a typed scan read: rows, sums and date range per group."""
    return p.df.groupBy(F.col(key).alias(name)).agg(
        F.count("*").alias("rows"),
        F.sum(p.cases).alias("cases"),
        F.sum(p.deaths).alias("deaths"),
        F.count(p.rate).alias("rates"),
        F.min(p.date).alias("first"),
        F.max(p.date).alias("last"),
    )


@query("s1_csv_scan", PANEL + SCAN_SQL.format(key="entity"))
def s1(spark, folder):
    p = read_panel(spark, observation_csv(spark, folder))
    return _scan(p, p.entity, "entity")


@query("s2_csv_scan_inferred", PANEL + SCAN_SQL.format(key="area"))
def s2(spark, folder):
    p = read_panel(spark, observation_csv(spark, folder), infer=True)
    return _scan(p, p.area, "area")


@query("s3_csv_scan_by_position", PANEL + SCAN_SQL.format(key="entity"))
def s3(spark, folder):
    p = read_panel(spark, observation_csv(spark, folder), by_position=True)
    return _scan(p, p.entity, "entity")


@query(
    "s4_csv_scan_with_month",
    PANEL + f"SELECT strftime(date, '%Y-%m') AS month, count(*) AS rows, {CASES} FROM panel GROUP BY 1",
)
def s4(spark, folder):
    p = read_panel(spark, observation_csv(spark, folder), add_month=True)
    return p.df.groupBy("month").agg(F.count("*").alias("rows"), F.sum(p.cases).alias("total_cases"))


@query("s5_load_table", PANEL + f"SELECT entity, {SUMS} FROM panel GROUP BY entity")
def s5(spark, folder):
    p = observations(spark, folder)
    stored = load_table(p.df, "panelkit_observations", fresh_path(spark, "table"))
    return totals(p.using(stored), p.entity)


@query(
    "s6_run_log_scan",
    LOG_FILES + """
    SELECT framework || '_' || workload || '_run' || week || '_data.time.txt' AS logfile, rss AS max_rss_kb, true AS complete
    FROM logs""",
)
def s6(spark, folder):
    logs = read_run_logs(spark, run_log_files(spark, folder))
    return logs.select(
        "logfile", max_rss_kb("text").alias("max_rss_kb"), F.col("text").contains("Exit status: 0").alias("complete")
    )


@query(
    "s7_run_result_scan",
    RUNS + """
    SELECT framework, workload, count(*) AS runs, count(wall_time_sec) AS timed, min(wall_time_sec) AS fastest,
           max(wall_time_sec) AS slowest, CAST(sum(max_rss_kb) AS BIGINT) AS rss
    FROM runs GROUP BY framework, workload""",
)
def s7(spark, folder):
    results = read_results(spark, run_result_csv(spark, folder))
    return results.groupBy("framework", "workload").agg(
        F.count("*").alias("runs"),
        F.count("wall_time_sec").alias("timed"),
        F.min("wall_time_sec").alias("fastest"),
        F.max("wall_time_sec").alias("slowest"),
        F.sum("max_rss_kb").alias("rss"),
    )


@query(
    "k1_write_csv",
    PANEL + f"""
    SELECT entity, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {SUMS}
    FROM panel GROUP BY 1, 2, 3""",
)
def k1(spark, folder):
    p = observations(spark, folder)
    return write_csv(trend(p, "month", p.entity), fresh_path(spark, "csv"))


@query(
    "k1_write_one_csv",
    PANEL + f"""
    SELECT entity, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {SUMS}
    FROM panel GROUP BY 1, 2, 3""",
)
def k1_one(spark, folder):
    p = observations(spark, folder)
    return write_one_csv(trend(p, "month", p.entity), f"{fresh_path(spark, 'csv')}.csv", ["year", "month", p.entity])


@query(
    "k2_replace_table",
    PANEL + f"""
    SELECT *, CASE WHEN total_cases > 0 THEN CAST(total_deaths AS DOUBLE) / total_cases ELSE 0 END AS ratio
    FROM (SELECT entity, {SUMS} FROM panel GROUP BY entity)""",
)
def k2(spark, folder):
    return write_table(ratio(observations(spark, folder)), fresh_path(spark, "result"))


@query(
    "k3_write_tsv",
    PANEL + f"""
    SELECT entity, total_cases, total_deaths,
           printf('%.6f', CASE WHEN total_cases > 0 THEN CAST(total_deaths AS DOUBLE) / total_cases ELSE 0 END) AS ratio
    FROM (SELECT entity, {SUMS} FROM panel GROUP BY entity)""",
)
def k3(spark, folder):
    result = ratio(observations(spark, folder))
    return write_tsv(result.withColumn("ratio", fmt_number("ratio", 6)), fresh_path(spark, "tsv"))


@query("k4_write_json", PANEL + f"SELECT area, {SUMS} FROM panel GROUP BY area")
def k4(spark, folder):
    p = observations(spark, folder)
    return write_json(totals(p, p.area), fresh_path(spark, "json"))


@query(
    "k5_show_rows",
    PANEL + f"""
    SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {SUMS}
    FROM panel GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 20""",
)
def k5(spark, folder):
    return show_rows(trend(observations(spark, folder), "month"), 20, quiet=True)


@query(
    "k6_summarize_result",
    PANEL + f"""
    SELECT entity, total_cases, count(*) OVER () AS groups
    FROM (SELECT entity, {CASES} FROM panel GROUP BY entity)
    ORDER BY total_cases DESC, entity LIMIT 5""",
)
def k6(spark, folder):
    p = observations(spark, folder)
    grouped = totals(p, p.entity, [p.cases])
    return summarize_result(grouped.orderBy(F.desc("total_cases"), p.entity), 5)


@query(
    "k1_write_top_csv",
    PANEL + f"SELECT entity, {SUMS} FROM panel GROUP BY entity ORDER BY total_cases DESC, entity LIMIT 15",
)
def k1_top(spark, folder):
    p = observations(spark, folder)
    return write_csv(top_n(totals(p, p.entity), "total_cases", 15, p.entity), fresh_path(spark, "csv"))
