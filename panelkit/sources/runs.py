"""Reading run logs and run results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.runtext import elapsed_seconds, log_name_parts, max_rss_kb

# The columns of a table of run results, and those that it must have.
RESULT_COLUMNS = ["framework", "workload", "runid", "wall_time_sec", "max_rss_kb", "logfile"]
REQUIRED_COLUMNS = {"framework", "wall_time_sec", "max_rss_kb", "logfile"}


def read_run_logs(spark: SparkSession, glob: str) -> DataFrame:
    """One row per log: (logfile, text). A log is a ``*.time.txt`` file, or a folder written by Spark."""
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, r"([^/=]+\.time\.txt)", 1)
    return spark.read.text(glob, wholetext=True).select(name.alias("logfile"), F.col("value").alias("text"))


def parse_run_logs(logs: DataFrame) -> DataFrame:
    """Run results out of logs; logs whose name has fewer than three parts are skipped."""
    parts = log_name_parts("logfile")
    return (
        logs.withColumns(parts)
        .filter(F.col("framework").isNotNull())
        .withColumns({"wall_time_sec": elapsed_seconds("text"), "max_rss_kb": max_rss_kb("text")})
        .select(*RESULT_COLUMNS)
    )


def coerce_results(df: DataFrame) -> DataFrame:
    """Trim the header, check the required columns, turn time and memory into numbers."""
    df = df.toDF(*[c.strip() for c in df.columns])
    missing = REQUIRED_COLUMNS - set(df.columns)
    if missing:
        raise ValueError(f"missing result columns: {sorted(missing)}")
    return df.withColumns(
        {
            "wall_time_sec": F.col("wall_time_sec").try_cast("double"),
            "max_rss_kb": F.col("max_rss_kb").try_cast("bigint"),
        }
    )


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Run results from CSV, columns found by header name."""
    return coerce_results(spark.read.option("header", True).option("escape", '"').csv(path))
