"""Token ids stored as compressed bit planes.

Ids of all documents, in ascending document order, form one stream cut into
blocks of a fixed number of ids.  A block is transposed into bit planes (plane
b holds bit b of every id), each plane is a zstandard frame, and a block is one
row of the file: Parquet is the container, so Spark's writer commits it and any
lost task can be repeated.  The chunk index is the other columns of the row
(shard, block number, ids, first and last document, document segments); a
reader that wants only the index prunes the planes.

Ranges of documents are shards; a shard's blocks are numbered from 0 and its
place in the stream is the sum of the ids of earlier shards (a table of one row
per shard).  Reading decodes blocks independently: a document that spans blocks
is put together from the lengths and checksums of its segments.

Edge cases: null and empty texts hold the end id alone; null document ids come
first; equal ids are ordered by a hash of the text (identical rows may stand in
either order); an empty table writes no block; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm.tokens import doc_ids, tokenizer_path

BLOCK_IDS = 1 << 16
SEGMENT = "struct<row: long, doc_id: long, start: long, n_tokens: long, part: int, length: int>"
BLOCK = f"shard int, block long, n_ids int, first_doc long, last_doc long, segments array<{SEGMENT}>, planes array<binary>"


def to_planes(ids: np.ndarray, level: int = 3) -> list[bytes]:
    """zstandard frames, one per bit, lowest first (16 planes, or 32 if an id needs them)."""
    import zstandard

    kind = "<u2" if len(ids) == 0 or ids.max() < 1 << 16 else "<u4"
    rows = ids.astype(kind).view(np.uint8).reshape(len(ids), -1)
    pack = zstandard.ZstdCompressor(level=level)
    out = []
    for byte in np.ascontiguousarray(rows.T):
        # any bit set counts as one, so the masked byte needs no shift
        out += [pack.compress(np.packbits(byte & np.uint8(1 << bit), bitorder="little").tobytes()) for bit in range(8)]
    return out


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    rows = np.zeros((len(planes) // 8, n_ids), dtype=np.uint8)
    for b, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(unpack.decompress(plane), dtype=np.uint8), bitorder="little", count=n_ids)
        rows[b // 8] |= bits << np.uint8(b % 8)
    return np.ascontiguousarray(rows.T).view(f"<u{len(rows)}").reshape(-1).astype("<u4")


def _block_type() -> pa.Schema:
    segment = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                         ("part", pa.int32()), ("length", pa.int32())])
    return pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("n_ids", pa.int32()), ("first_doc", pa.int64()),
                      ("last_doc", pa.int64()), ("segments", pa.list_(segment)), ("planes", pa.list_(pa.binary()))])


def write_ids(docs: DataFrame, target: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
              block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the blocks of all shards under ``target``."""
    path = path or tokenizer_path()
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    src = (src.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
           .sortWithinPartitions("doc_id", "h").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, schema = TaskContext.get().partitionId(), _block_type()
        held, size, segments, block, row, start = [], 0, [], 0, 0, 0

        def flush():
            nonlocal held, size, segments, block
            ids = np.concatenate(held)
            own = [s["doc_id"] for s in segments if s["doc_id"] is not None]
            out = {"shard": shard, "block": block, "n_ids": size, "first_doc": min(own, default=None),
                   "last_doc": max(own, default=None), "segments": segments, "planes": to_planes(ids)}
            held, size, segments, block = [], 0, [], block + 1
            return pa.RecordBatch.from_pylist([out], schema=schema)

        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, ids in doc_ids(batch.column(1).to_pylist(), path, capacity=350_000):
                at, part = 0, 0
                while at < len(ids):
                    n = min(block_ids - size, len(ids) - at)
                    held.append(ids[at:at + n])
                    segments.append({"row": row, "doc_id": names[i], "start": start, "n_tokens": len(ids), "part": part, "length": n})
                    size, at, part = size + n, at + n, part + 1
                    if size == block_ids:
                        yield flush()
                row, start = row + 1, start + len(ids)
        if size:
            yield flush()

    src.mapInArrow(run, BLOCK).write.option("compression", "none").parquet(target)


def read_blocks(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(source)


def read_ids(spark: SparkSession, source: str, checksums: bool = False) -> DataFrame:
    """Per block segment: shard, row, doc_id, start in the shard, n_tokens, part, length, ids (little-endian uint32).

    ``checksums`` gives ``crc`` (the ids' crc32) instead of the ids, which then never leave the task that decodes them."""
    name, kind = ("crc", pa.int64()) if checksums else ("ids", pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                data, at = from_planes(b["planes"], b["n_ids"]).tobytes(), 0
                rows = []
                for s in b["segments"]:
                    ids = data[4 * at:4 * (at + s["length"])]
                    rows.append({"shard": b["shard"], **s, name: zlib.crc32(ids) if checksums else ids})
                    at += s["length"]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("shard", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                     ("part", pa.int32()), ("length", pa.int32()), (name, kind)]))

    return (read_blocks(spark, source).select("shard", "n_ids", "segments", "planes")
            .mapInArrow(run, "shard int, row long, doc_id long, start long, n_tokens long, part int, length int, "
                        + ("crc long" if checksums else "ids binary")))


def join_checksums(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation from the (bytes, crc32) of its parts."""
    total = 0
    for size, crc in parts:
        zeros = bytes(size)
        # crc32 is affine: the running value shifted past `size` bytes, plus the part's own
        total = zlib.crc32(zeros, total) ^ zlib.crc32(zeros) ^ crc
    return total


def document_checksums(spark: SparkSession, source: str) -> DataFrame:
    """Per document: doc_id, start (ids of all earlier documents), n_tokens, ids_crc32 - all from the files."""
    @F.pandas_udf("long")
    def joined(parts):
        return parts.map(lambda ps: join_checksums([(4 * p["length"], p["crc"]) for p in ps]))

    segments = C.persisted(read_ids(spark, source, checksums=True), "bitplanes-segments")
    whole = F.col("length") == F.col("n_tokens")
    key = ["shard", "row", "doc_id", "start", "n_tokens"]
    spanning = (segments.where(~whole).groupBy(*key)
                .agg(F.sort_array(F.collect_list(F.struct("part", "length", "crc"))).alias("parts"))
                .select(*key, joined("parts").alias("ids_crc32")))
    docs = segments.where(whole).select(*key, F.col("crc").alias("ids_crc32")).unionByName(spanning)
    per_shard = read_blocks(spark, source).groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = per_shard.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return docs.join(base, "shard").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
