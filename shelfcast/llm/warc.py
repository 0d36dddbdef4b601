"""WARC archives: write, read, and revisit resolution.

Archives are plain WARC/1.1 files.  A record is header, CRLF CRLF, payload,
CRLF CRLF; Spark's text writer with the record terminator as line separator
writes them with its own commit protocol, so a lost or repeated task leaves no
half file.  Archives are gzip files of a bounded size; a reading task takes a
whole archive and walks it by Content-Length.

``resolve_revisits`` shuffles only headers by payload digest: the smallest
(page id, record id) of each digest is the response, joined back to the
records; the deduplicated archives are written with fresh headers.

Edge cases: a null payload is an empty one; null page ids come after all
others when the response is chosen; repeated rows are separate records (one
response, the rest revisit it); a revisit whose response is in none of the
archives stays a revisit with its own reference; an empty table writes no
record and reads back as no row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.session import scratch_path

END = "\r\n\r\n"
ARCHIVE_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id long, url string, record_id string, record_type string, payload_digest string, "
          "payload_bytes long, refers_to long, refers_to_record string, payload string")
FIELDS = [f.split()[0] for f in RECORD.split(", ")]


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_text(page_id, url, record_id, record_type, digest, n_bytes, refers_to, refers_to_record, payload, date) -> str:
    """One record without its terminator."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    body = payload or "" if record_type == "response" else ""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {clean}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        f"X-Payload-Length: {n_bytes}",
        *([f"WARC-Profile: {PROFILE}"] if record_type == "revisit" else []),
        *([f"WARC-Refers-To: <urn:uuid:{refers_to_record}>"] if refers_to_record else []),
        *([f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else []),
        "Content-Type: text/html",
        f"Content-Length: {len(body.encode())}",
    ]
    return "\r\n".join(lines) + END + body


def write_archives(records: DataFrame, path: str, mean_bytes: float = 4096, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write RECORD rows as archives of about ``archive_bytes`` each, given the mean payload size."""
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            values = [record_text(*row, date) for row in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    (records.select(*FIELDS).mapInArrow(render, "value string")
     .write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", max(1, int(archive_bytes / max(mean_bytes + 500, 1)))).text(path))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive (gzip or plain), one record at a time."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {version[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        yield head, stream.read(int(head["Content-Length"]))
        stream.read(len(END))


def _row(head: dict[str, str], block: bytes) -> tuple:
    whole = lambda k: int(head[k]) if k in head else None
    urn = lambda k: head[k][len("<urn:uuid:"):-1] if k in head else None
    response = head["WARC-Type"] == "response"
    digest = payload_digest(block) if response else head.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    return (whole("X-Page-ID"), head.get("WARC-Target-URI"), urn("WARC-Record-ID"), head["WARC-Type"], digest,
            len(block) if response else whole("X-Payload-Length"), whole("X-Refers-To-Page-ID"), urn("WARC-Refers-To"),
            block.decode() if response else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Response and revisit records of all archives under ``path``; digest and length come from the payload read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("content")
    schema = RECORD if payloads else RECORD.rpartition(",")[0]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for head, block in parse_archive(batch.column(0)[i].as_py()):
                    if head["WARC-Type"] in ("response", "revisit"):
                        rows.append(_row(head, block)[:len(names)])
                        size += len(block) if payloads else 0
                    if len(rows) >= 2000 or size > 4 << 20:
                        yield _batch(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names, types)

    return files.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: dict) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, type=types.get(n, pa.string())) for n, c in zip(names, cols, strict=True)], names=names)


def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """One response record per row of ``pages``; ids are drawn anew at each evaluation, so write before resolving."""
    src = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                       F.coalesce(F.col(payload), F.lit("")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b.encode() for b in batch.column(2).to_pylist()]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([str(uuid.uuid4()) for _ in range(n)], pa.string()),
                pa.array(["response"] * n, pa.string()), pa.array([payload_digest(b) for b in bodies], pa.string()),
                pa.array([len(b) for b in bodies], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
                batch.column(2),
            ], names=FIELDS)

    return src.mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """RECORD rows with one response per payload digest; the other records of it become revisits.

    Only headers are grouped by digest (partial aggregation first, so a digest
    held by a third of the records does not meet in one task); the join back is
    a plain equi-join whose skewed side adaptive execution splits.
    Payloads under ``min_bytes`` all stay responses.
    """
    kept = (records.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
            .groupBy("payload_digest")
            .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record_id", "payload_bytes")).alias("first"),
                 F.count("*").alias("copies"))
            .withColumnRenamed("payload_digest", "digest"))
    own = F.col("first.record_id") == F.col("record_id")
    revisit = F.col("first").isNotNull() & ~own & (F.col("record_type").isin("response", "revisit"))
    joined = records.join(kept, F.col("payload_digest") == F.col("digest"), "left")
    return joined.select(
        "page_id", "url", "record_id",
        F.when(revisit, "revisit").otherwise(F.col("record_type")).alias("record_type"), "payload_digest",
        F.coalesce(F.when(revisit, F.col("first.payload_bytes")), F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("first.page_id")).when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"),
        F.when(revisit, F.col("first.record_id")).when(F.col("record_type") == "revisit", F.col("refers_to_record")).alias("refers_to_record"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def dedup_archives(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Read the archives under ``source`` and write deduplicated ones, with fresh headers, under ``target``.

    The digest shuffle carries headers only; payloads move once, to meet their resolved header.
    Headers are kept beside the archives, so these are unpacked twice, not once for each use of a header.
    """
    kept = scratch_path(spark, "llm", "warc-heads")
    headers = read_archives(spark, source, payloads=False)
    headers.write.option("compression", "zstd").parquet(kept)
    heads = spark.read.schema(headers.schema).parquet(kept).withColumn("payload", F.lit(None).cast("string"))
    resolved = resolve_revisits(heads, min_bytes).select(
        F.col("record_id").alias("rid"), "record_type", "payload_bytes", "refers_to", "refers_to_record")
    bodies = read_archives(spark, source).select("page_id", "url", "record_id", "payload_digest", "payload")
    mean = heads.agg(F.avg("payload_bytes")).first()[0] or 0
    write_archives(bodies.join(resolved, F.col("record_id") == F.col("rid")), target, mean)
