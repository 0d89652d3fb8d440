"""WARC archives: writing captures, reading records, and assembling the records of a transaction.

``write`` makes three records per page: request, response (or revisit, for a payload that a page with a smaller id has
too), and metadata; request and metadata name their response in WARC-Concurrent-To. Spark's text sink writes the
archives, gzipped: records as lines, and the end of a line is the two line ends that close a WARC record. So
they lie on any file system Spark knows, and a lost task leaves no half archive.

``read`` parses whole files by Content-Length; ``FILE_CAPTURES`` bounds what ``write`` puts into one. ``assemble`` joins what one
capture left behind and emits one nested row for it, with a single small shuffle and states of fixed size.

Defined cases: null html is an empty payload, a null id or address is left out of the headers (null when read); line ends in addresses are
dropped; of equal payloads (``REVISIT_BYTES`` or more), the smallest id is the response, of several rows with that id one of the
same address and payload; a record whose capture is missing makes a row with a null response; of several
records of one kind the first by record id counts; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

REVISIT_BYTES = 100
FILE_CAPTURES = 2_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id(kind: str, capture: Column, copy: Column) -> Column:
    """A record id made of the kind and the capture, which of equal rows is one copy."""
    h = F.md5(F.concat_ws("/", F.lit(kind), capture, copy.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column, own_id: Column, block: Column, headers: list[tuple[str, Column]]) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in headers]  # null values leave no line
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), own_id),
        F.lit(f"WARC-Date: {DATE}"),
        *lines,
        length,
    )
    return F.concat(head, F.lit("\r\n\r\n"), block)


def write(pages: DataFrame, path: str) -> None:
    """Archive ``pages`` (page_id, url, html) under ``path``."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").alias("bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("digest")
    )
    # a capture is known by what it holds, so that it is the same however often and wherever the pages are read
    rows = rows.withColumn("capture", F.md5(F.to_json(F.struct("page_id", "url", "digest"))))
    light = rows.groupBy("capture", "digest", "bytes", "page_id").agg(F.count("*").alias("copies"))
    shared = light.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "capture")).alias("first"), F.sum("copies").alias("n")
    )
    first = shared.where("n > 1").select("digest", F.col("first.capture").alias("first"))
    marks = light.join(first, "digest", "left").where("first is not null or copies > 1").select("capture", "first", "copies")
    rows = rows.join(written(marks, "shared-payloads"), "capture", "left")  # by capture: no key is hot
    several = F.coalesce(F.col("copies") > 1, F.lit(False))
    copies = rows.where(several).groupBy("capture").agg(*[F.first(c).alias(c) for c in rows.columns if c != "capture"])
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1)))
    rows = rows.where(~several).withColumn("copy", F.lit(0)).unionByName(copies)
    rows = rows.withColumn("again", F.coalesce((F.col("first") != F.col("capture")) | (F.col("copy") > 0), F.lit(False)) & F.col("first").isNotNull())

    uri = F.regexp_replace("url", "[\r\n]", "")
    response = _id("response", F.col("capture"), F.col("copy"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    get = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))
    fields = F.concat_ws("\r\n", F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit(""))
    asked = _record(
        F.lit("request"),
        _id("request", F.col("capture"), F.col("copy")),
        get,
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/http; msgtype=request"))],
    )
    got = _record(
        F.when(F.col("again"), "revisit").otherwise("response"),
        response,
        F.when(F.col("again"), http).otherwise(F.concat(http, F.col("payload"))),
        [
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            ("WARC-Profile", F.when(F.col("again"), PROFILE)),
            ("WARC-Refers-To", F.when(F.col("again"), _id("response", F.col("first"), F.lit(0)))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
    )
    about = _record(
        F.lit("metadata"),
        _id("metadata", F.col("capture"), F.col("copy")),
        fields,
        [("WARC-Target-URI", uri), ("WARC-Concurrent-To", response), ("Content-Type", F.lit("application/warc-fields"))],
    )
    end = "\r\n\r\n"
    archive = rows.select(F.concat(asked, F.lit(end), got, F.lit(end), about).alias("value"))
    archive.write.option("lineSep", end).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option(
        "maxRecordsPerFile", FILE_CAPTURES
    ).text(path)


RECORDS = (
    "record_id string, type string, date string, uri string, concurrent_to string, refers_to string, "
    "declared_digest string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"
)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive's bytes."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers: dict[str, str] = {}
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), value.strip())
        length = headers.get("content-length", "")
        size = int(length) if length.isdigit() else 0
        yield headers, data[end + 4 : end + 4 + size]
        at = data.find(b"WARC/", end + 4 + size)


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = headers.get("warc-type")
    payload = fields = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    elif kind == "resource":
        payload = block
    elif kind == "metadata":
        pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line)
        fields = [(name.strip(), value.strip()) for name, _, value in pairs]
    return (
        headers.get("warc-record-id"),
        kind,
        headers.get("warc-date"),
        headers.get("warc-target-uri"),
        headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"),
        headers.get("warc-payload-digest"),
        None if payload is None else hashlib.sha256(payload).hexdigest(),
        None if payload is None else len(payload),
        fields,
        payload if with_payload else None,
    )


_NAMES = ["record_id", "type", "date", "uri", "concurrent_to", "refers_to", "declared_digest", "payload_digest", "payload_bytes", "fields", "payload"]
_TYPES = [*[pa.string()] * 8, pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path``, plain or gzipped; the digest and size of a payload are measured."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows = [_row(headers, block, with_payload) for headers, block in records(data)]
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
                yield pa.RecordBatch.from_arrays(columns, _NAMES)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select("content").mapInArrow(parse, RECORDS)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: its id and the structs ``response`` (or revisit or resource), ``request`` and ``metadata``.

    Records name each other in either direction and over one step more (metadata of a request): a record
    belongs to the capture it names, or that names it, or to that of the request it names.
    """
    is_capture = F.col("type").isin("response", "revisit", "resource")
    captures = found.where(is_capture)
    others = found.where(~is_capture | F.col("type").isNull())
    named = captures.where("concurrent_to is not null").groupBy(F.col("concurrent_to").alias("named_id")).agg(F.min("record_id").alias("namer"))
    others = others.join(named, F.col("record_id") == F.col("named_id"), "left").withColumn(
        "capture_id", F.coalesce("namer", "concurrent_to", "record_id")
    ).drop("named_id", "namer")
    steps = others.where("type = 'request' and capture_id != record_id").groupBy(F.col("record_id").alias("step")).agg(F.min("capture_id").alias("onward"))
    others = others.join(steps, F.col("capture_id") == F.col("step"), "left").withColumn("capture_id", F.coalesce("onward", "capture_id")).drop("step", "onward")
    everything = captures.withColumn("capture_id", F.col("record_id")).unionByName(others)
    own = {
        "response": (is_capture, ["record_id", "type", "date", "uri", "refers_to", "declared_digest", "payload_digest", "payload_bytes", "payload"]),
        "request": (F.col("type") == "request", ["record_id", "date", "uri"]),
        "metadata": (F.col("type") == "metadata", ["record_id", "date", "fields"]),
    }
    # fields are a map, which has no order, so the first is chosen by record id alone
    firsts = [F.min_by(F.when(which, F.struct(*columns)), F.when(which, F.col("record_id"))).alias(name) for name, (which, columns) in own.items()]
    return everything.groupBy("capture_id").agg(*firsts, F.count("*").alias("n_records"))
