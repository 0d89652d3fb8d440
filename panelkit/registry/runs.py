"""Run results: summaries, medians, boxes."""

from pyspark.sql import functions as F

from ..constants import FRAMEWORK_ORDER, VARIANT_ORDER
from ..functions.runtext import variant_of_log
from ..operators.ranking import order_by_category
from ..operators.runstats import (
    box_stats,
    run_summary,
    variant_medians,
    with_variant,
    workload_medians,
    workload_summary,
)
from ..sources.warehouse import run_results
from . import query
from .sql import RUNS


def rounded(df, digits=6):
    """Doubles to fixed digits: means and deviations depend on the order of summation."""
    doubles = [c for c, dtype in df.dtypes if dtype == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _q(c: str, x: float) -> str:
    return f"quantile_cont(CAST({c} AS DOUBLE), {x})"


def _summary(by: str, source: str) -> str:
    return f"""
    SELECT {by}, count(wall_time_sec) AS n,
           round(avg(wall_time_sec), 6) AS mean_time, round(stddev_samp(wall_time_sec), 6) AS std_time,
           round(avg(max_rss_kb), 6) AS mean_rss_kb,
           round({_q('wall_time_sec', 0.5)}, 6) AS median_time, round({_q('wall_time_sec', 0.25)}, 6) AS q1_time,
           round({_q('wall_time_sec', 0.75)}, 6) AS q3_time, round({_q('max_rss_kb', 0.5)}, 6) AS median_rss_kb,
           round({_q('wall_time_sec', 0.75)} - {_q('wall_time_sec', 0.25)}, 6) AS iqr_time
    FROM {source} GROUP BY {by}"""


@query("a21_run_summary", RUNS + _summary("framework, workload, log_variant", "runs"))
def a21(spark, folder):
    runs = run_results(spark, folder).withColumn("log_variant", variant_of_log("logfile"))
    return rounded(run_summary(runs, ("framework", "workload", "log_variant")))


@query("a21_run_summary_by_run_variant", RUNS + _summary("framework, workload, variant", "named"))
def a21_variant(spark, folder):
    return rounded(run_summary(with_variant(run_results(spark, folder))))


@query(
    "a22_workload_summary",
    RUNS + f"""
    SELECT framework, workload, n, median_time AS median, iqr_time AS iqr, mean_time AS mean, std_time AS std,
           median_rss_kb FROM ({_summary('framework, workload', 'runs')})""",
)
def a22(spark, folder):
    return rounded(workload_summary(run_results(spark, folder)))


VARIANT_MEDIANS = RUNS + f"""
SELECT lower(framework) AS framework, log_variant AS variant, count(*) AS n,
       round({_q('wall_time_sec', 0.5)}, 6) AS median_time,
       round({_q('max_rss_kb / CAST(1024 AS DOUBLE)', 0.5)}, 6) AS median_rss_mb
FROM runs GROUP BY 1, 2
"""


@query("a23_variant_medians", VARIANT_MEDIANS)
def a23(spark, folder):
    return rounded(variant_medians(run_results(spark, folder)))


@query(
    "a24_workload_medians",
    RUNS + f"""
    SELECT framework, workload,
           CASE lower(variant) WHEN 'small' THEN 'small' WHEN 'large' THEN 'big' ELSE 'normal' END AS variant,
           round({_q('wall_time_sec', 0.5)}, 6) AS median_time, round({_q('max_rss_kb', 0.5)}, 6) AS median_rss_kb
    FROM named GROUP BY 1, 2, 3""",
)
def a24(spark, folder):
    return rounded(workload_medians(run_results(spark, folder)))


def _boxes(by: str, value: str) -> str:
    return f"""
    , boxes AS (
      SELECT {by}, {_q(value, 0.25)} AS q1, {_q(value, 0.5)} AS median, {_q(value, 0.75)} AS q3 FROM runs GROUP BY {by}
    )
    SELECT {by}, round(least(min(CAST({value} AS DOUBLE)), q1), 6) AS whisker_low, round(q1, 6) AS q1,
           round(median, 6) AS median, round(q3, 6) AS q3,
           round(greatest(max(CAST({value} AS DOUBLE)), q3), 6) AS whisker_high
    FROM runs JOIN boxes USING ({by})
    WHERE {value} BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5
    GROUP BY {by}, boxes.q1, boxes.median, boxes.q3"""


@query("a25_time_boxes", RUNS + _boxes("framework, workload", "wall_time_sec"))
def a25_time(spark, folder):
    return rounded(box_stats(run_results(spark, folder), ["framework", "workload"], "wall_time_sec"))


@query("a25_memory_boxes", RUNS + _boxes("framework", "max_rss_kb"))
def a25_memory(spark, folder):
    return rounded(box_stats(run_results(spark, folder), ["framework"], "max_rss_kb"))


@query("t9_variant_order", VARIANT_MEDIANS)
def t9_variants(spark, folder):
    medians = rounded(variant_medians(run_results(spark, folder)))
    return order_by_category(medians, {"variant": VARIANT_ORDER, "framework": FRAMEWORK_ORDER})
