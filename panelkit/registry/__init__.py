"""Every operator as a query on the given tables, with the same query in SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import fit_shuffles

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Date columns of its result become text, as they are in the SQL."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            folder = str(folder).rstrip("/")
            fit_shuffles(spark, folder)
            df = build(spark, folder)
            dates = [c for c, dtype in df.dtypes if dtype == "date"]
            return df.withColumns({c: df[c].cast("string") for c in dates}) if dates else df

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


from . import jobs, names, rows, runs, scalars, storage, totals, trends  # noqa: E402,F401
