"""Sinks and named tables. Each returns what it wrote, read back."""

from __future__ import annotations

import csv
import io
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import one_value


POINTER = "current.txt"  # names the version of a stored result that readers see


def load_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace the named table by the rows of ``df``, in ``path`` if given.

    With a path the rows are a new version there, and the table's location is moved to it once they are all written.
    """
    spark = df.sparkSession
    if path is None:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
        return spark.table(name)
    location = _new_version(df, path)
    spark.catalog.dropTempView(name)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, location, "parquet")
    _point(spark, path, location)
    return spark.table(name)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a result stored as Parquet in a folder.

    The rows become a new version beside the old one, and one small file, which a rename replaces, says which is read. A write that fails
    leaves the old rows, and ``df`` may itself be derived from them. Older versions stay for readers that began before, until removed.
    """
    location = _new_version(df, path)
    _point(df.sparkSession, path, location)
    return df.sparkSession.read.schema(df.schema).parquet(location)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last complete ``write_table``; a plain Parquet folder as it is."""
    files, pointer = _files(spark, f"{path.rstrip('/')}/{POINTER}")
    if not files.exists(pointer):
        return spark.read.parquet(path)
    return spark.read.parquet(spark.read.text(pointer.toString()).first()[0])


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path on it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _new_version(df: DataFrame, path: str) -> str:
    location = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(location)
    return location


def _point(spark: SparkSession, path: str, location: str) -> None:
    """Name the version that is read: written beside the pointer, then renamed over it, which readers see whole or not at all."""
    fresh = f"{path.rstrip('/')}/{POINTER}-{uuid.uuid4().hex}"
    _put(spark, fresh, location)
    _rename(spark, fresh, f"{path.rstrip('/')}/{POINTER}")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file."""
    files, target = _files(spark, path)
    out = files.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def _rename(spark: SparkSession, path: str, over: str) -> None:
    """Rename a file over another one, if there is one."""
    jvm = spark.sparkContext._jvm
    fresh = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(over), overwrite)


def write_csv(df: DataFrame, path: str) -> DataFrame:
    """CSV with a header in every part file. A sorted top-N result is a single file."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    reader = df.sparkSession.read.schema(df.schema).option("header", True).option("escape", '"')
    return reader.csv(path)


def write_one_csv(df: DataFrame, path: str, order: list[str | Column], parts: int | None = None) -> DataFrame:
    """One CSV file at ``path``, header once, rows in the given order; a file already there is replaced when the new one is complete.

    Tasks write ranges of the order (so many ``parts``, or as many as AQE sees fit) without a header. Their files are joined by the file
    system: where it can, without touching the data, else as a stream of small buffers. No task and no process holds the rows.
    """
    spark = df.sparkSession
    work = f"{path}-{uuid.uuid4().hex}"
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if parts else df.orderBy(*order)
    ordered.write.option("escape", '"').csv(work)
    files, folder = _files(spark, work)
    found = [(int(m[1]), s.getPath().getName(), s.getPath()) for s in files.listStatus(folder) if s.getLen() and (m := re.match(r"part-(\d+)", s.getPath().getName()))]
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(df.columns)
    _put(spark, f"{work}/header", head.getvalue())
    _rename(spark, _joined(spark, work, [x[2] for x in sorted(found, key=lambda x: x[:2])]), path)
    files.delete(folder, True)
    return spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(path)


def _joined(spark: SparkSession, work: str, parts: list) -> str:
    """The header and the parts as one file."""
    jvm = spark.sparkContext._jvm
    files, header = _files(spark, f"{work}/header")
    whole = f"{work}/whole"
    if parts and files.getScheme() != "file":  # there, concat would copy too, and take its first file for a target
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            sources[i] = part
        try:
            files.concat(header, sources)
            return f"{work}/header"
        except Exception as error:  # a file system that cannot
            if "UnsupportedOperationException" not in str(error):
                raise
    out = files.create(_files(spark, whole)[1], True)
    for part in [header, *parts]:
        source = files.open(part)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 65536, False)
        source.close()
    out.close()
    return whole


def write_tsv(df: DataFrame, path: str) -> DataFrame:
    """Tab-separated text without a header."""
    df.write.mode("overwrite").option("sep", "\t").csv(path)
    return df.sparkSession.read.schema(df.schema).option("sep", "\t").csv(path)


def write_json(df: DataFrame, path: str) -> DataFrame:
    """One JSON document per line."""
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def show_rows(df: DataFrame, n: int = 20, quiet: bool = False) -> DataFrame:
    """The first n rows as a DataFrame, printed unless ``quiet``."""
    first = df.limit(n)
    if not quiet:
        first.show(n, truncate=False)
    return first


def summarize_result(df: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows of a result, each with the number of all its rows as ``groups``."""
    return df.limit(n).withColumn("groups", one_value(df, F.count("*")))
