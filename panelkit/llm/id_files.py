"""Token ids of a corpus in Simple-8b files, and reading them back.

A set of files is a folder: ``frames`` holds the ids, ``shards`` how many ids lie before each shard. Both are Parquet files
that Spark writes and commits, so they work on any file system it knows and survive lost tasks. A frame is a
run of whole documents in ascending order of id, of ``FRAME`` ids or just over: its documents and where
each begins, its packed words, the first word of each block of 1024 ids, and the escapes. A shard
is what one task wrote; shards ascend too.

Defined cases: null and empty texts have only the end id; null document ids come first; repeated ids are all
kept, in the order of their texts; an empty table gives empty files; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, utf8
from .simple8b import pack, unpack
from .tokens import encoder

FRAME = 1 << 19

FRAMES = (
    "shard int, frame int, start long, doc_ids array<long>, ends array<long>, "
    "words binary, blocks array<int>, escapes array<long>"
)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write the files to ``path``."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, frame, before = TaskContext.get().partitionId(), 0, 0
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            numbers = np.frombuffer(b"".join(ids), "<u4")
            words, blocks, escapes = pack(numbers)
            ends = np.cumsum([len(x) // 4 for x in ids])
            row = [shard, frame, before, doc_ids, ends.tolist(), words.astype("<u8").tobytes(), blocks.tolist(), escapes.tolist()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        names = ["shard", "frame", "start", "doc_ids", "ends", "words", "blocks", "escapes"]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id").to_pylist()
            for low, high in chunks(utf8(texts)[1]):
                for key, x in zip(keys[low:high], encode(texts.slice(low, high - low)), strict=True):
                    doc_ids.append(key)
                    ids.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= FRAME:
                        yield close()
                        frame, before, held = frame + 1, before + held, 0
                        doc_ids, ids = [], []
        if doc_ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(frames, FRAMES).write.parquet(f"{path}/frames")
    spark = docs.sparkSession
    sizes = spark.read.schema(FRAMES).parquet(f"{path}/frames").groupBy("shard").agg(
        F.max(F.col("start") + F.element_at("ends", -1)).alias("n")
    )
    up_to = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, not per document
    sizes.select("shard", F.coalesce(F.sum("n").over(up_to), F.lit(0)).alias("before")).write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 and, if wanted, its ids."""
    frames = spark.read.schema(FRAMES).parquet(f"{path}/frames")
    shards = spark.read.schema("shard int, before long").parquet(f"{path}/shards")
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.array(row["ends"], np.int64)
                starts = np.concatenate(([0], ends[:-1]))
                words = np.frombuffer(row["words"], "<u8").astype(np.uint64)
                blocks, escapes = np.array(row["blocks"], np.int64), np.array(row["escapes"], np.uint64)
                ids = unpack(words, blocks, escapes, int(ends[-1])).astype("<u4")
                raw = memoryview(ids.tobytes())
                out = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": starts + row["start"] + row["before"],
                    "n_tokens": ends - starts,
                    "ids_crc32": np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], np.int64),
                }
                if with_ids:
                    out["ids"] = pa.ListArray.from_arrays(
                        np.append(starts, ends[-1]).astype(np.int32), ids.astype(np.int32)
                    )
                yield pa.RecordBatch.from_pydict(out)

    return frames.join(shards, "shard").mapInArrow(documents, schema)
