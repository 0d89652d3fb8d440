"""Scalar functions, each over a whole table, summed up by its result."""

from pyspark.sql import functions as F

from ..functions.calendar import (
    bucket_label,
    iso_week,
    month_of,
    month_start,
    to_day,
    week_year_of,
    year_of,
)
from ..functions.runtext import (
    elapsed_seconds,
    log_name_parts,
    lower_label,
    max_rss_kb,
    normalize_variant,
    variant_of,
    variant_of_log,
)
from ..functions.values import (
    clean_name,
    fmt_number,
    guarded,
    relabel,
    scale,
    strip_parens,
    to_number,
    zero_if_null,
)
from ..sources.warehouse import observation_text, observations, run_log_rows, run_results, table
from . import query
from .sql import PANEL, RUNS, clean


def _counted(df, **columns):
    """How often each result of the functions occurs."""
    return df.select(*[c.alias(name) for name, c in columns.items()]).groupBy(*columns).agg(F.count("*").alias("rows"))


def _count_sql(source: str, table: str, **columns: str) -> str:
    listed = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"{source} SELECT {', '.join(columns)}, count(*) AS rows FROM (SELECT {listed} FROM {table}) GROUP BY ALL"


@query(
    "x1_to_number",
    _count_sql(PANEL, "panel", whole="try_cast(rate AS BIGINT)", real="try_cast(rate AS DOUBLE)", none="try_cast(entity AS BIGINT)"),
)
def x1(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, whole=to_number("rate"), real=to_number("rate", "double"), none=to_number("entity"))


@query(
    "x2_parse_date",
    _count_sql(PANEL, "panel", day="CAST(date AS VARCHAR)", partly="CASE WHEN area <> 'ASIA' THEN CAST(date AS VARCHAR) END"),
)
def x2(spark, folder):
    df = observation_text(spark, folder)
    other_order = F.concat_ws("-", "year", "month", "day")
    mixed = F.when(F.col("continentExp") == "ASIA", other_order).otherwise(F.col("dateRep"))
    return _counted(df, day=to_day("dateRep"), partly=to_day(mixed))


@query(
    "x3_year_month",
    _count_sql(PANEL, "panel", year="CAST(year(date) AS INTEGER)", month="CAST(month(date) AS INTEGER)"),
)
def x3(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, year=year_of("date"), month=month_of("date"))


@query(
    "x4_iso_week",
    _count_sql(
        PANEL, "panel", iso_year="CAST(isoyear(date) AS INTEGER)", year="CAST(year(date) AS INTEGER)",
        week="CAST(week(date) AS INTEGER)",
    ),
)
def x4(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, iso_year=week_year_of("date"), year=week_year_of("date", "calendar"), week=iso_week("date"))


@query(
    "x5_bucket_labels",
    _count_sql(
        PANEL, "panel", day="strftime(date, '%Y-%m-%d')", month="strftime(date, '%Y-%m')",
        week="printf('%04d-W%02d', isoyear(date), week(date))",
        calendar_week="printf('%04d-W%02d', year(date), week(date))",
    ),
)
def x5(spark, folder):
    df = observations(spark, folder).df
    return _counted(
        df,
        day=bucket_label("date", "day"),
        month=bucket_label("date", "month"),
        week=bucket_label("date", "week"),
        calendar_week=bucket_label("date", "week", "calendar"),
    )


@query("x6_month_start", _count_sql(PANEL, "panel", start="CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR)"))
def x6(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, start=month_start(year_of("date"), month_of("date")))


@query("x7_clean_name", _count_sql(PANEL, "panel", label=clean("spelled")))
def x7(spark, folder):
    return _counted(observations(spark, folder).df, label=clean_name("spelled"))


@query(
    "x8_relabel",
    _count_sql(PANEL, "panel", label="CASE entity WHEN 'NATION_8' THEN 'N8' WHEN 'NATION_13' THEN 'N13' ELSE entity END"),
)
def x8(spark, folder):
    return _counted(observations(spark, folder).df, label=relabel("entity", {"NATION_8": "N8", "NATION_13": "N13"}))


@query("x9_strip_parens", _count_sql(PANEL, "panel", label="trim(regexp_replace(spelled, '\\s*\\(.*\\)', ''))"))
def x9(spark, folder):
    return _counted(observations(spark, folder).df, label=strip_parens("spelled"))


@query(
    "x10_guarded",
    _count_sql(PANEL, "panel", share="CASE WHEN deaths > 0 THEN CAST(cases AS DOUBLE) / deaths ELSE 0 END"),
)
def x10(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, share=guarded(F.col("deaths") > 0, scale("cases", "deaths"), 0.0))


@query(
    "x11_scale",
    _count_sql(RUNS, "runs", mb="max_rss_kb / CAST(1024 AS DOUBLE)", per_cent="max_rss_kb / CAST(20000 AS DOUBLE) * 100"),
)
def x11(spark, folder):
    return _counted(run_results(spark, folder), mb=scale("max_rss_kb", 1024), per_cent=scale("max_rss_kb", 20_000, 100))


@query("x12_zero_if_null", _count_sql(PANEL, "panel", rate="coalesce(try_cast(rate AS BIGINT), 0)", pop="coalesce(pop, 0)"))
def x12(spark, folder):
    df = observations(spark, folder).df
    return _counted(df, rate=zero_if_null(to_number("rate")), pop=zero_if_null("pop"))


@query(
    "x13_number_formats",
    _count_sql(
        "", "lineitem", fixed="printf('%.3f', l_quantity / 7)", percent="printf('%.1f%%', l_quantity / 70 * 100)",
        thousands="format('{:,.1f}', l_quantity * 1000 / 7)",
    ),
)
def x13(spark, folder):
    quantity = F.col("l_quantity")
    return _counted(
        table(spark, folder, "lineitem"),
        fixed=fmt_number(quantity / 7, 3),
        percent=fmt_number(quantity / 70, 1, "percent"),
        thousands=fmt_number(quantity * 1000 / 7, 1, "thousands"),
    )


@query(
    "x14_elapsed_seconds",
    _count_sql(
        "WITH logs AS (SELECT CAST(round(value * 100) AS BIGINT) * 60 AS h FROM events)", "logs",
        seconds="CASE WHEN h >= 360000 THEN CAST(h // 100 AS DOUBLE)"
        " ELSE CAST(h // 6000 * 60 AS DOUBLE) + CAST(h % 6000 AS DOUBLE) / 100 END",
    ),
)
def x14(spark, folder):
    return _counted(run_log_rows(spark, folder), seconds=elapsed_seconds("text"))


@query("x15_max_rss", _count_sql(RUNS, "runs", rss="max_rss_kb"))
def x15(spark, folder):
    return _counted(run_log_rows(spark, folder), rss=max_rss_kb("text"))


@query(
    "x16_log_name_parts",
    RUNS + """
    SELECT framework, workload, count(*) AS runs, count(DISTINCT regexp_extract(logfile, '_run([0-9]+)', 1)) AS runids
    FROM runs GROUP BY framework, workload""",
)
def x16(spark, folder):
    parts = run_results(spark, folder).select(*[c.alias(n) for n, c in log_name_parts("logfile").items()])
    return parts.groupBy("framework", "workload").agg(
        F.count("*").alias("runs"), F.countDistinct("runid").alias("runids")
    )


@query("x17_variant", _count_sql(RUNS, "named", label="variant"))
def x17(spark, folder):
    return _counted(run_results(spark, folder), label=variant_of("runid", "logfile"))


@query("x18_variant_of_log", _count_sql(RUNS, "runs", label="log_variant"))
def x18(spark, folder):
    return _counted(run_results(spark, folder), label=variant_of_log("logfile"))


@query(
    "x19_normalize_variant",
    _count_sql(
        RUNS, "named",
        label="CASE lower(variant) WHEN 'small' THEN 'small' WHEN 'large' THEN 'big' ELSE 'normal' END",
    ),
)
def x19(spark, folder):
    return _counted(run_results(spark, folder), label=normalize_variant(variant_of("runid", "logfile")))


@query("x20_lower_label", _count_sql("", "customer", label="lower(c_mktsegment)"))
def x20(spark, folder):
    return _counted(table(spark, folder, "customer"), label=lower_label("c_mktsegment"))
