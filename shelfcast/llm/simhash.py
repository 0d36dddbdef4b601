"""SimHash near-duplicates with pivot distance tables.

Fingerprint: 64 bits over all word shingles of the lower-cased text (repeats
count), a bit being set if more than half of the shingle hashes have it.

Links (at most ``distance`` differing bits) are searched among distinct
fingerprints.  The 64 bits are cut into ``r`` blocks; fingerprints within the
distance agree on some ``r - distance`` of them, so rows meet in groups keyed by
those bits.  ``r`` grows with the number of distinct fingerprints so that groups
of unrelated fingerprints stay small; every choice finds every link.  Inside a
group a table holds each fingerprint's Hamming distances to fixed reference
fingerprints (pivots): a pair whose distances to any pivot differ by more than
the limit is discarded (triangle inequality), survivors are verified bit by
bit.  Tasks emit a spanning forest of the links, not all pairs.  A group over
``tile`` rows is cut into tiles and the pairs of tiles are separate groups, so
no task holds more than two tiles.

Edge cases: null, empty and white-space texts have fingerprint zero and link
like any other; texts under one shingle hash as a whole; equal fingerprints are
one component whatever their number; repeated rows each get a row; null ids are
ignored when the smallest id is taken (null if a component has no other); an
empty table gives no row; other columns are ignored or carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C
from shelfcast.llm.components import connected

SHINGLE = 4
DISTANCE = 4
SEED = 42
TILE = 4096
GROUP = 256
N_PIVOTS = 16


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh64_intdigest(joined, seed)]
    else:
        at = [0, *accumulate(len(w) + 1 for w in words)]
        hashes = [xxh64_intdigest(joined[a:b - 1], seed) for a, b in zip(at, at[shingle:], strict=False)]
    counts = np.zeros(64, dtype=np.int64)
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    for i in range(0, len(rows), 1 << 15):
        counts += np.unpackbits(rows[i:i + (1 << 15)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with a long column ``name`` holding the 64 bits."""
    schema = C.with_fields(docs, [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            prints = np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield C.append_columns(batch, schema, {name: prints})

    return docs.mapInArrow(run, schema)


def block_masks(distance: int, distinct: int, group: int = GROUP) -> list[int]:
    """Signed 64-bit masks: any two values within ``distance`` bits agree under one of them."""
    for r in range(distance + 1, 65):
        edges = [64 * i // r for i in range(r + 1)]
        blocks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
        if distinct / 2 ** (64 * (r - distance) // r) <= group or r == distance + 8:
            masks = [sum(c) for c in combinations(blocks, r - distance)]
            return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    raise ValueError("distance over 63")


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 64, n, dtype=np.uint64)


class Forest:
    """Vectorised union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def link_groups(prints: np.ndarray, group: np.ndarray, distance: int, refs: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """Root index per row: rows of a group joined by chains of at most ``distance`` differing bits."""
    table = np.bitwise_count(prints[:, None] ^ refs[None, :]).astype(np.int16)
    order = np.lexsort((table[:, 0], group))
    prints, table = prints[order], table[order]
    rank = np.cumsum(np.concatenate([[0], np.diff(group[order]) != 0])) * 256 + table[:, 0]
    ends = np.searchsorted(rank, rank + distance, side="right")
    width = ends - np.arange(len(rank)) - 1
    forest, total = Forest(len(rank)), np.cumsum(width)
    start = 0
    while start < len(rank):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + chunk, side="right")))
        n = width[start:stop]
        a = np.repeat(np.arange(start, stop), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        for p in range(1, table.shape[1]):  # the first pivot is the sort order
            near = np.abs(table[a, p] - table[b, p]) <= distance
            a, b = a[near], b[near]
        close = np.bitwise_count(prints[a] ^ prints[b]) <= distance
        forest.link(a[close], b[close])
        start = stop
    out = np.empty(len(order), dtype=np.int64)
    out[order] = order[forest.root]
    return out


def links(distinct: DataFrame, count: int, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect exactly the chains of links among ``distinct`` (column fp)."""
    masks = block_masks(distance, count)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "bits"))
    sizes = keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    keyed = keyed.join(sizes, ["mask", "bits"])
    tiles = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), tiles)
    keyed = (keyed.withColumn("t", mine).withColumn("o", F.explode(F.sequence(F.lit(0), tiles - 1)))
             .select("fp", F.xxhash64("mask", "bits", F.least("t", "o"), F.greatest("t", "o")).alias("cell")))
    keyed = keyed.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots()
        fps, cells = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def solve(fps, cells):
            root = link_groups(fps.view(np.uint64), cells, distance, refs)
            moved = root != np.arange(len(fps))
            return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[root[moved]])], names=["u", "v"])

        for batch in batches:
            fps = np.concatenate([fps, batch.column(0).to_numpy(zero_copy_only=False)])
            cells = np.concatenate([cells, batch.column(1).to_numpy(zero_copy_only=False)])
            if len(fps) >= 8 * tile:
                cut = int(np.searchsorted(cells, cells[-1]))  # the last cell may go on
                if cut:
                    yield solve(fps[:cut], cells[:cut])
                    fps, cells = fps[cut:], cells[cut:]
        if len(fps):
            yield solve(fps, cells)

    return keyed.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fp (64 bits as a long), component_id (smallest id reachable by links), root (the component's smallest fp)."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marked = C.persisted(fingerprints(src, "text", "fp", shingle).select("doc_id", "fp"), "simhash-prints")
    distinct = C.persisted(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = connected(links(distinct.select("fp"), distinct.count(), distance))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = placed.join(lowest, "root").select("fp", "component_id", "root")
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """Rows of ``docs`` with one document of each component (its smallest id), columns unchanged."""
    found = near_duplicates(docs, id_col, text_col, shingle, distance)
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
            .agg(F.first("component_id").alias("kept_id"), F.min("fp").alias("kept_fp")).drop("root"))
    mine = fingerprints(docs.withColumn("_own", F.struct(*docs.columns)).select("_own", F.col(text_col).alias("text")), "text", "_fp", shingle)
    mine = mine.select("_own", "_fp", F.col(f"_own.{id_col}").cast("long").alias("_id"))
    held = mine.join(kept, F.col("_id").eqNullSafe(F.col("kept_id")) & (F.col("_fp") == F.col("kept_fp")), "left_semi")
    return held.dropDuplicates(["_id", "_fp"]).select("_own.*")
