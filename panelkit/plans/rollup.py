"""Sums per entity, area and day that outlive a choice of filters, and grow with the files they were read from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..binding import Panel
from ..operators.totals import totals
from ..session import settled
from ..sources.tables import _files, read_table, write_table

MANIFEST = "path string, state string, part string"


def _daily(p: Panel) -> DataFrame:
    return totals(p, [p.entity, p.area, p.date]).withColumnsRenamed({f"total_{m}": m for m in p.measures})


def _states(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Number, size and time of the files of each path."""
    found = {}
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        found[path] = "/".join(map(str, files.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string")).first()))
    return found


def rollup(spark: SparkSession, folder: str, paths: list[str], read: Callable[[list[str]], Panel]) -> Panel:
    """The panel of some paths (files or folders), summed per entity, area and day; kept in ``folder``.

    ``read`` makes the panel of some of the paths. While their files are as they were, nothing is read but the sums; paths that are new
    are read, and their sums added to those there; if one has changed or is gone, all are read again. A choice of
    filters on the result, as in ``dashboard``, costs no scan of the facts.
    """
    now = _states(spark, paths)
    files, at = _files(spark, f"{folder.rstrip('/')}/manifest")
    kept = [tuple(r) for r in read_table(spark, at.toString()).collect()] if files.exists(at) else []  # a row per path
    if any(now.get(path) != state for path, state, _ in kept):
        kept = []
    new = sorted(set(now) - {path for path, _, _ in kept})
    panel = read(new or paths)
    if new:
        part = settled(_daily(panel), "rollup").inputFiles()
        home = part[0].rsplit("/", 1)[0]
        kept += [(path, now[path], home) for path in new]
        write_table(spark.createDataFrame(kept, MANIFEST), at.toString())
    parts = sorted({part for _, _, part in kept})
    sums = spark.read.parquet(*parts)
    if len(parts) > 1:  # an entity's day may be in several
        sums = _daily(panel.using(sums))
    return panel.using(sums)
