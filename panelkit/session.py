"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


PARTITION_BYTES = 128 * 1024**2  # what a shuffle partition should hold before AQE merges small ones


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Enough partitions for the largest shuffle; AQE merges them where there is less."""
    return max(200, -(-shuffle_bytes // PARTITION_BYTES))


def build_session(
    app: str, master: str | None = None, shuffle_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings the operators are tuned for.

    AQE merges small shuffle partitions and splits skewed ones, but it cannot split a partition
    that is merely too large, so give the size of the largest shuffle as ``shuffle_bytes``: about
    the columns of the panel that are read. No operator gives a broadcast hint: Catalyst and AQE
    broadcast a side only when its size is under the threshold.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    if shuffle_bytes:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fitted: set[tuple[str, str]] = set()


def fit_shuffles(spark: SparkSession, folder: str) -> None:
    """Raise the number of shuffle partitions to what tables of this size need, once per folder.

    The files' sizes are read, not their content. A larger setting is left as it is.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key in _fitted:
        return
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    size = files.agg(F.sum("length")).first()[0] or 0
    needed = -(-size // PARTITION_BYTES)
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    _fitted.add(key)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    root = spark.conf.get("panelkit.local.folder", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="panelkit-")
    spark.conf.set("panelkit.local.folder", root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/panelkit/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and go on from there.

    For tables that several results are derived from: each is computed once, and a lost executor
    costs no recomputation of what lies before.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
