"""What the operators share: reading tables, folds by checksum, texts as Arrow buffers, written tables."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.session import fresh_path

CHUNK_BYTES = 2 * 1024**2  # text handled at once in a task; a longer text is a chunk of its own


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per Spark context, for clusters where it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_panelkit_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="panelkit-code-")) / "panelkit.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    context._panelkit_shipped = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def in_fold(doc_id: Column, parts: int, part: int) -> Column:
    """True if the id falls in one part; a null id falls in none."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def added(df: DataFrame, keep: list[str], fields: str) -> StructType:
    """The schema of the columns ``keep`` of ``df`` and further fields."""
    return StructType(df.select(*keep).schema.fields + StructType.fromDDL(fields).fields)


def whole_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Each row as one column ``row``, which no column of an operator clashes with, and the columns that it works on."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *columns)


def written(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write to the shared folder and read again: computed once, and nothing to recompute after a loss."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside drops its shuffled data when it ends. For results that are written or collected once; none may be run again outside."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def released(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A step over batches that gives what it has freed back to the system when its task ends, as the Python process lives on."""

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return run


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets into them, without a copy. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at.astype(np.int64)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; every row is in exactly one."""
    rows, low = len(offsets) - 1, 0
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high
