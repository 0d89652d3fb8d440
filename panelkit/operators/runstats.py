"""Summaries of benchmark runs: framework, workload, runid, wall_time_sec, max_rss_kb, logfile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runtext import lower_label, normalize_variant, variant_of, variant_of_log
from .quantiles import quantiles

TIME, MEMORY = "wall_time_sec", "max_rss_kb"
QUARTILES = [0.25, 0.5, 0.75]


def with_variant(res: DataFrame) -> DataFrame:
    """Adds ``variant`` as named by the run id or the log."""
    return res.withColumn("variant", variant_of("runid", "logfile"))


def with_log_variant(res: DataFrame) -> DataFrame:
    """Adds ``variant`` by the log's ending, ``max_rss_mb``, and lower-cases the framework."""
    return res.withColumns(
        {
            "variant": variant_of_log("logfile"),
            "framework": lower_label("framework"),
            "max_rss_mb": F.col(MEMORY) / 1024.0,
        }
    )


def suspect_runs(res: DataFrame, limit: float = 0.5) -> DataFrame:
    """Runs too short to be real."""
    return res.filter(F.col(TIME) <= limit).select("framework", "workload", "runid", TIME, "logfile")


def run_summary(
    res: DataFrame, by: Sequence[str] = ("framework", "workload", "variant"), approx: bool = False
) -> DataFrame:
    """Count, median, mean, deviation and quartiles of the time, median and mean memory.

    Groups with a null key are left out. ``approx`` takes the quartiles from sketches, in one
    aggregation.
    """
    by = list(by)
    if approx:
        times = F.percentile_approx(TIME, QUARTILES).cast("array<double>")
        grouped = res.na.drop(subset=by).groupBy(*by)
        summary = grouped.agg(
            F.count(TIME).alias("n"),
            times[1].alias("median_time"),
            F.avg(TIME).alias("mean_time"),
            F.stddev_samp(TIME).alias("std_time"),
            times[0].alias("q1_time"),
            times[2].alias("q3_time"),
            F.percentile_approx(MEMORY, 0.5).cast("double").alias("median_rss_kb"),
            F.avg(MEMORY).alias("mean_rss_kb"),
        )
    else:
        also = [
            F.avg(TIME).alias("mean_time"),
            F.stddev_samp(TIME).alias("std_time"),
            F.avg(MEMORY).alias("mean_rss_kb"),
        ]
        times, memory = F.col(f"q_{TIME}"), F.col(f"q_{MEMORY}")
        summary = quantiles(res, by, [TIME, MEMORY], QUARTILES, also).select(
            *by,
            F.col(f"n_{TIME}").alias("n"),
            times[1].alias("median_time"),
            "mean_time",
            "std_time",
            times[0].alias("q1_time"),
            times[2].alias("q3_time"),
            memory[1].alias("median_rss_kb"),
            "mean_rss_kb",
        )
    return summary.withColumn("iqr_time", F.col("q3_time") - F.col("q1_time"))


def workload_summary(res: DataFrame, approx: bool = False) -> DataFrame:
    """The short summary per framework and workload, variants pooled."""
    return run_summary(res, ("framework", "workload"), approx).select(
        "framework",
        "workload",
        "n",
        F.col("median_time").alias("median"),
        F.col("iqr_time").alias("iqr"),
        F.col("mean_time").alias("mean"),
        F.col("std_time").alias("std"),
        "median_rss_kb",
    )


def variant_medians(res: DataFrame) -> DataFrame:
    """Median time, median MB and number of runs per framework and log variant."""
    by, memory = ["framework", "variant"], "max_rss_mb"
    found = quantiles(with_log_variant(res), by, [TIME, memory], [0.5], [F.count("*").alias("n")])
    return found.select(
        *by, F.col(f"q_{TIME}")[0].alias("median_time"), F.col(f"q_{memory}")[0].alias("median_rss_mb"), "n"
    )


def workload_medians(res: DataFrame) -> DataFrame:
    """Median time and memory per framework, workload and normalised variant."""
    by = ["framework", "workload", "variant"]
    named = with_variant(res).withColumn("variant", normalize_variant("variant"))
    found = quantiles(named, by, [TIME, MEMORY], [0.5])
    return found.select(
        *by, F.col(f"q_{TIME}")[0].alias("median_time"), F.col(f"q_{MEMORY}")[0].alias("median_rss_kb")
    )


def box_stats(res: DataFrame, by: Sequence[str], c: str) -> DataFrame:
    """Quartiles and whiskers of a box plot: the whiskers end at the last value within 1.5 IQR.

    A whisker never ends inside the box, also where no value lies between fence and quartile. The fences are a table
    of a row per group; the values inside them are one more aggregation of the same rows.
    """
    by = list(by)
    q1, median, q3 = (F.col(f"q_{c}")[i] for i in range(3))
    reach = (q3 - q1) * 1.5
    boxes = quantiles(res, by, [c], QUARTILES).where(F.col(f"n_{c}") > 0)
    boxes = boxes.select(*by, F.struct(q1.alias("q1"), median.alias("median"), q3.alias("q3"), (q1 - reach).alias("from"), (q3 + reach).alias("to")).alias("_box"))
    value = F.col("_value")
    inside = F.when(value.between(F.col("_box.from"), F.col("_box.to")), value)
    return (
        res.select(*by, F.col(c).cast("double").alias("_value"))
        .join(boxes, by)
        .groupBy(*by)
        .agg(F.any_value("_box").alias("_box"), F.min(inside).alias("low"), F.max(inside).alias("high"))
        .select(
            *by,
            F.least("low", "_box.q1").alias("whisker_low"),
            "_box.q1",
            "_box.median",
            "_box.q3",
            F.greatest("high", "_box.q3").alias("whisker_high"),
        )
    )
