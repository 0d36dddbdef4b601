"""Harmonic packing of token ids into fixed-capacity sequences.

Lengths fall into reciprocal-capacity classes: class ``s`` holds pieces of
``s`` ids and its bins take a fixed count of ``capacity // s`` of them.  Only
sizes that leave next to no rest (``capacity % s <= capacity // 256``) are
classes; a document is cut into whole sequences first and its rest, largest
class first, into pieces that fit a class exactly.

Every worker numbers its own pieces per class.  The only thing workers share
is the count per (shard, class), a table of shards x classes rows: its running
sums turn local numbers into global ones, and number // count is the bin.  The
incomplete last bin of each class (under ``capacity`` pieces per class at any
input size) is packed first-fit by decreasing length in one small task.

Edge cases: null and empty texts are the end id alone (one piece of one id);
repeated rows are packed row by row; ties need no order; an empty table gives
no row; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm.tokens import doc_ids, tokenizer_path

CAPACITY = 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, shard int, number long, ids binary"


def class_sizes(capacity: int) -> list[int]:
    """Piece sizes, largest first."""
    return [s for s in range(capacity, 0, -1) if capacity % s <= capacity // 256]


def cut_lengths(n: int, capacity: int, sizes: list[int]) -> list[int]:
    """Piece lengths of a document of ``n`` ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    for s in sizes:
        if rest >= s:
            out += [s] * (rest // s)
            rest %= s
        if not rest:
            break
    return out


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int, with_ids: bool) -> DataFrame:
    """Pieces of every document, numbered per (shard, length)."""
    names = [f.split()[0] for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, sizes, seen = TaskContext.get().partitionId(), class_sizes(capacity), Counter()
        for batch in batches:
            ids_in, rows = batch.column(0).to_pylist(), []
            for i, ids in doc_ids(batch.column(1).to_pylist(), path):
                data, start = memoryview(ids.astype("<u4").tobytes()), 0
                for n in cut_lengths(len(ids), capacity, sizes):
                    part = data[4 * start:4 * (start + n)]
                    rows.append((ids_in[i], start, n, zlib.crc32(part), len(ids), shard, seen[n], bytes(part) if with_ids else None))
                    seen[n] += 1
                    start += n
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.binary()], strict=True)],
                    names=names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, PIECES)


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) per length; ``lengths`` in decreasing order."""
    room, out = [], []
    for n in lengths:
        b = next((i for i, r in enumerate(room) if r >= n), len(room))
        if b == len(room):
            room.append(capacity)
        out.append((b, capacity - room[b]))
        room[b] -= n
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``; ``ids`` (little-endian uint32) when asked for."""
    pieces = C.persisted(cut_pieces(docs, id_col, text_col, path or tokenizer_path(), capacity, with_ids), "packing-pieces")
    counts = pieces.groupBy("shard", "length").agg((F.max("number") + 1).alias("n"))
    counts = C.persisted(counts, "packing-counts")  # shards x classes rows
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = counts.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    per_bin = F.floor(F.lit(capacity) / F.col("length"))
    classes = counts.groupBy("length").agg(F.sum("n").alias("total")).withColumn("per_bin", per_bin)
    classes = classes.withColumn("bins", F.floor(F.col("total") / F.col("per_bin")))
    # one row per class (a fixed number): first sequence of the class
    ahead = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("base", F.coalesce(F.sum("bins").over(ahead), F.lit(0)))
    at = (pieces.join(shards, ["shard", "length"]).join(classes, "length")
          .withColumn("index", F.col("before") + F.col("number")))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
    full = at.where(F.col("index") < F.col("bins") * F.col("per_bin")).select(
        *keep, (F.col("base") + F.floor(F.col("index") / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.pmod(F.col("index"), F.col("per_bin")) * F.col("length")).cast("long").alias("offset"))
    whole = classes.select(F.coalesce(F.sum("bins"), F.lit(0))).scalar()
    rest = at.where(F.col("index") >= F.col("bins") * F.col("per_bin")).select(*keep, "index", whole.alias("whole"))
    out_schema = full.schema

    def tail(frames):
        import pandas as pd

        rows = pd.concat(list(frames), ignore_index=True)  # under capacity pieces per class
        if len(rows):
            rows = rows.sort_values(["length", "index"], ascending=[False, True], ignore_index=True)
            spots = np.array(first_fit(rows["length"].tolist(), capacity), dtype=np.int64)
            rows["sequence_id"], rows["offset"] = rows["whole"].astype("int64") + spots[:, 0], spots[:, 1]
            yield rows[[f.name for f in out_schema.fields]]

    packed = full.unionByName(rest.repartition(1).mapInPandas(tail, out_schema))
    return packed if with_ids else packed.drop("ids")
