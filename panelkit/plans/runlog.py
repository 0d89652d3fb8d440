"""From run logs to a results table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.runs import parse_run_logs, read_results, read_run_logs
from ..sources.tables import write_csv


def run_log_job(spark: SparkSession, glob: str, out: str) -> DataFrame:
    """Parse all logs, write the results as CSV, read them back."""
    write_csv(parse_run_logs(read_run_logs(spark, glob)), out)
    return read_results(spark, out)
