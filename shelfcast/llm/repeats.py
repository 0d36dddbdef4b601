"""Repeated-passage removal: prefix ranks at growing lengths, as in distributed prefix doubling.

A window is a string of ``length`` bytes inside one text; every byte of a
window that also starts anywhere else goes.  Ranking all positions round after
round would shuffle the corpus many times over, so ranks are kept for chosen
positions only: the window's smallest hashed ``gram`` (leftmost on ties) is its
anchor.  Equal windows have equal anchors at equal offsets, so nothing is lost.

* rank at the gram's length: Spark counts the grams of all anchors; an anchor
  whose gram is unique drops out, with every window it stands for;
* rank past the threshold: surviving anchors are ranked again by the pair
  (gram, all bytes its windows span).  A pair held by several anchors means all
  their windows are repeated;
* what is left are anchors that share a gram but not the whole span, the ends
  of repeated passages.  One member of each such pair is ranked again by the
  gram with half of its neighbourhood, and where that is shared by every window
  at its offset from the gram: one narrow row per rank, counted in Spark.

Spans that share a gram are never gathered, however many they are: equal ranks
meet in partial counts.  Everything a document loses is joined back to its text
once.

Edge cases: null counts as empty; texts under ``length`` bytes lose nothing;
repeated rows are repeats of each other and go whole; rows with equal ids are
told apart by a hash of the text; overlapping windows of one text count; bytes
may leave part of a character, which ``remove_repeats`` drops from its string;
an empty table gives no row; other columns are carried unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C

LENGTH = 200
GRAM = 64
CHUNK = 5_000
_LOW32 = np.uint64(0xFFFFFFFF)


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive entries, by doubling."""
    out, span = x, 1
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[:len(out) - (w - span)], out[w - span:]) if span < w else out


def anchors(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(position, first window, last window, gram rank, span rank) of every anchor of one text."""
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return none, none, none, none, none
    sums = C.PrefixHash(raw)
    h = sums.grams(gram)
    key = (h & ~_LOW32) | np.arange(len(h), dtype=np.uint64)
    at = (window_min(key, length - gram + 1) & _LOW32).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.concatenate([starts[1:], [len(at)]]) - 1
    pos = at[starts]
    shape = ((pos - starts) << 8 | (pos - ends)).astype(np.uint64)
    span = C.mix64(sums.ranges(starts, ends + length) + shape * np.uint64(0x9E3779B97F4A7C15))
    return pos, starts, ends, h[pos].view(np.int64), ((span & ~np.uint64(0xFFFF)) | shape).view(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.shiftright(F.xxhash64(body), 32).cast("int").alias("h"), body.cast("binary").alias("body"))


def anchor_rows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(g, c, doc_id, spot): gram rank, span rank (its low 16 bits hold the window offsets), place (h and position)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            bodies = [np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in batch.column(2)]
            for a, b in C.text_runs([len(v) for v in bodies], 8 << 20):
                found = [anchors(v, length, gram) for v in bodies[a:b]]
                sizes = [len(f[0]) for f in found]
                if not sum(sizes):
                    continue
                spot = [f[0] | (h << 32) for f, h in zip(found, hs[a:b], strict=True)]
                owner = pa.array(np.repeat(np.arange(b - a), sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([f[3] for f in found])), pa.array(np.concatenate([f[4] for f in found])),
                     pa.array(ids[a:b], pa.int64()).take(owner), pa.array(np.concatenate(spot))],
                    names=["g", "c", "doc_id", "spot"])

    return texts.mapInArrow(run, "g long, c long, doc_id long, spot long")


def _place():
    """h and position out of ``spot``; first window, last window out of the span rank's low bits."""
    pos = F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF))
    shape = F.col("c").bitwiseAND(F.lit(0xFFFF))
    return (F.shiftright("spot", 32).cast("int").alias("h"), (pos - F.shiftright(shape, 8)).alias("first"),
            (pos - shape.bitwiseAND(F.lit(0xFF))).alias("last"))


def rank_keys(g: np.ndarray, c: np.ndarray, halves: np.ndarray, spans: list[bytes], length: int, gram: int, width: int) -> tuple[np.ndarray, ...]:
    """(row, group, rank) per group of ``width`` neighbouring offsets that a span's windows have; width 1 is the window.

    A group's rank is that of the bytes all its offsets' windows have in common,
    so a window repeated elsewhere has a repeated rank at every width.  Bit b of
    ``halves`` lets the span's offsets of half b through.
    """
    low, high = c & 0xFF, (c >> 8) & 0xFF
    first = low // width
    count = high // width - first + 1
    row = np.repeat(np.arange(len(g)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    mine = (halves[row] >> (at * width // half_width(length, gram))) & 1 == 1
    row, at = row[mine], at[mine]
    size = np.fromiter(map(len, spans), dtype=np.int64, count=len(spans))
    anchor = (np.cumsum(size) - size + high)[row]
    near, far = at * width, np.minimum(at * width + width - 1, length - gram)
    h = C.PrefixHash(np.frombuffer(b"".join(spans), dtype=np.uint8)).ranges(anchor - near, anchor - far + length)
    return row, at, C.mix64(h + C.mix64(at.astype(np.uint64))).view(np.int64)


def half_width(length: int, gram: int) -> int:
    """Offsets in one of the two halves of all offsets 0 to ``length - gram``."""
    return (length - gram) // 2 + 1


def _edge_ranks(edges: DataFrame, texts: DataFrame, length: int, gram: int, width: int, chunk: int) -> DataFrame:
    """One narrow row (g, rank, c, n, doc_id, spot, at) per group of offsets of every edge (g, c, n, doc_id, spot, halves)."""
    # spans wanted of one document: bounded by the document's own length
    wanted = (edges.select(F.col("doc_id").alias("id2"), _place()[0].alias("h2"), F.struct("g", "c", "n", "spot", "halves").alias("e"))
              .groupBy("id2", "h2").agg(F.collect_list("e").alias("es")))
    joined = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, es = batch.column(1), batch.column(2)
            owner = np.repeat(np.arange(batch.num_rows), es.value_lengths().to_numpy())
            e = pa.RecordBatch.from_struct_array(es.flatten())
            ids = batch.column(0).take(pa.array(owner))
            for start in range(0, e.num_rows, chunk):
                part, own = e.slice(start, chunk), owner[start:start + chunk]
                g, c, n, spot, halves = (part.column(k).to_numpy() for k in range(5))
                body = {i: bodies[i].as_py() for i in np.unique(own).tolist()}
                pos = spot & 0xFFFFFFFF
                spans = [body[i][a:b] for i, a, b in zip(own.tolist(), (pos - (c >> 8 & 0xFF)).tolist(), (pos - (c & 0xFF) + length).tolist(), strict=True)]
                row, at, rank = rank_keys(g, c, halves, spans, length, gram, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[row]), pa.array(rank), pa.array(c[row]), pa.array(n[row]), ids.slice(start, chunk).take(pa.array(row)),
                     pa.array(spot[row]), pa.array(at)], names=["g", "rank", "c", "n", "doc_id", "spot", "at"])

    return joined.select("doc_id", "body", "es").mapInArrow(run, "g long, rank long, c long, n long, doc_id long, spot long, at long")


def _shared(ranks: DataFrame, tag: str) -> DataFrame:
    """Rows of ``ranks`` whose (g, rank) other rows have too, a single-member span among them."""
    again = ranks.groupBy("g", "rank").agg(F.count("*").alias("k"), F.min("n").alias("low")).where("k > 1 and low = 1").select("g", "rank")
    return ranks.join(C.persisted(again, tag), ["g", "rank"])


def _end_ranges(edges: DataFrame, texts: DataFrame, length: int, gram: int, chunk: int) -> DataFrame:
    """(doc_id, h, range): byte ranges (start and end packed in one long) of repeated windows of single-member spans."""
    spark = texts.sparkSession
    # ranked first by the bytes common to each half of the offsets, as in doubling; only shared halves are ranked by window
    halves = C.persisted(_edge_ranks(edges.withColumn("halves", F.lit(3).cast("long")), texts, length, gram, half_width(length, gram), chunk), "repeats-halves")
    C.release(spark)
    left = _shared(halves, "repeats-half-ranks").groupBy("g", "c", "n", "doc_id", "spot").agg(F.bit_or(F.col("at") + 1).alias("halves"))
    left = C.persisted(left, "repeats-left")
    C.release(spark)
    windows = C.persisted(_edge_ranks(left, texts, length, gram, 1, chunk).drop("c"), "repeats-windows")
    C.release(spark)
    start = F.col("spot").bitwiseAND(F.lit(0xFFFFFFFF)) - F.col("at")
    # windows of one anchor: at most length - gram + 1
    hit = (_shared(windows, "repeats-window-ranks").where("n = 1").groupBy("doc_id", "spot")
           .agg(F.sort_array(F.collect_list(start)).alias("starts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(2).flatten().to_numpy()
            if not len(starts):
                continue
            owner = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
            # windows of an anchor that follow each other become one range
            head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)]))
            tail = np.concatenate([head[1:], [len(starts)]]) - 1
            rows = pa.array(owner[head])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(starts[head] << 32 | (starts[tail] + length))],
                                             names=["doc_id", "h", "range"])

    return hit.select("doc_id", _place()[0], "starts").mapInArrow(run, "doc_id long, h int, range long")


def repeated_ranges(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, h, ranges): byte ranges (packed longs, unmerged) each text loses; texts that lose nothing are absent."""
    spark = texts.sparkSession
    rows = anchor_rows(texts, length, gram)
    # written first: the join then has an exchange of its own on either side, and a very common gram's rows can be split
    grams = C.persisted(rows.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("g"), "repeats-grams")
    C.release(spark)
    hits = C.persisted(rows.join(grams, "g"), "repeats-hits")
    C.release(spark)
    spans = C.persisted(hits.groupBy("g", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "spot")).alias("one")), "repeats-spans")
    shared = C.persisted(spans.groupBy("g").agg(F.count("*").alias("k")).where(F.col("k") > 1).select("g"), "repeats-shared")
    edges = spans.join(shared, "g").select("g", "c", "n", "one.doc_id", "one.spot")
    ends = C.persisted(_end_ranges(edges, texts, length, gram, chunk), "repeats-ends")
    C.release(spark)
    h, first, last = _place()
    whole = hits.join(spans.where(F.col("n") > 1).select("g", "c"), ["g", "c"]).select(
        "doc_id", h, (F.shiftleft(first, 32) + last + F.lit(length)).alias("range"))
    out = C.persisted(whole.unionByName(ends).groupBy("doc_id", "h").agg(F.collect_set("range").alias("ranges")), "repeats-ranges")
    C.release(spark)
    return out


def merge_ranges(packed: list[int]) -> list[tuple[int, int]]:
    """Ascending maximal (start, end) runs."""
    out: list[list[int]] = []
    for r in sorted(packed):
        start, end = r >> 32, r & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def keep_bytes(body: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for start, end in runs:
        parts.append(body[at:start])
        at = end
    return b"".join([*parts, body[at:]])


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int, chunk: int) -> DataFrame:
    """(own: the row, text, ranges) of every document."""
    found = repeated_ranges(_texts(docs, id_col, text_col), length, gram, chunk)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("h").alias("found_h"), "ranges")
    hashed = F.shiftright(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 32).cast("int")
    mine = docs.select(F.struct(*docs.columns).alias("own"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), hashed.alias("h"))
    return mine.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h")), "left").select("own", "text", "ranges")


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    joined = _with_ranges(src, "doc_id", "text", length, gram, chunk)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, packed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                body, runs = (text or "").encode(), merge_ranges(packed or [])
                rows.append((doc_id, len(body), sum(b - a for a, b in runs), len(runs), hashlib.sha256(keep_bytes(body, runs)).hexdigest()))
            if rows:
                types = [pa.int64()] * 4 + [pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.select("own.doc_id", "text", "ranges").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   chunk: int = CHUNK) -> DataFrame:
    """``docs`` with repeated passages cut from the text (incomplete characters dropped), columns unchanged."""
    joined = _with_ranges(docs, id_col, text_col, length, gram, chunk).select("own", "text", "ranges")
    schema = T.StructType([joined.schema["own"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if t is None or not r else keep_bytes(t.encode(), merge_ranges(r)).decode("utf-8", "ignore")
                     for t, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["own", "text"])

    cut = joined.mapInArrow(run, schema)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col("own")[c].alias(c) for c in docs.columns])
