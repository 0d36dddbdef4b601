"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A text is a sequence of words (its symbols).  Every run of ``window``
consecutive words of a benchmark item is a pattern; an item of fewer words is
one pattern.  Patterns of equal length share one set of Wu-Manber tables:

* shift table: block of two words -> how far the window may jump without
  passing an occurrence (a block in no pattern allows ``length - 1`` words);
* suffix-hash buckets: the patterns that end in a block, keyed by the hash of
  that block and of the first word;
* direct comparison of the words confirms an occurrence.

Spark scans the documents once per pattern block with a broadcast of that
block's tables: flat arrays over one buffer of the block's words, some 25 bytes
a word and 16 MB of shifts.  A pattern block is bounded (``block_bytes`` of
benchmark text), so the broadcast is too; a larger benchmark is searched block
after block, each block's result being written before the next one's tables
are built, without a shuffle.

Edge cases: null or empty texts have no words and never hit; repeated rows are
scored row by row; items with a null id still hit but are not listed; an empty
benchmark hits nothing; input columns named like an output column give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C

WINDOW = 10
BLOCK_BYTES = 16 << 20
# bytes hashed at a time, so that the hash keeps its tables of powers
HASH_BYTES = C.KEPT_POWERS - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)

# Word bytes after lower-casing A-Z: digits, a-z and everything beyond ASCII; the rest separates.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)

OUT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.IntegerType())),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
]


def normal(text: str | None) -> bytes:
    """The words of a text with one space between them."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(_FOLD).split()) if text else b""


class Words:
    """Words of a normalised text: byte offsets and a 64-bit hash of each."""

    def __init__(self, body: bytes):
        self.body = body
        data = np.frombuffer(body, dtype=np.uint8)
        edge = [len(data)] if body else []
        breaks = np.append(np.flatnonzero(data == 0x20), edge).astype(np.int64)
        self.starts, self.ends = np.concatenate([[0], breaks[:-1] + 1]) if body else breaks, breaks
        n = len(breaks)
        self.hashes = np.empty(n, dtype=np.uint64)
        at = 0
        while at < n:  # a bounded run of bytes at a time
            low = int(self.starts[at])
            to = max(at + 1, int(np.searchsorted(self.ends, low + HASH_BYTES, side="right")))
            run = C.PrefixHash(data[low:int(self.ends[to - 1])])
            self.hashes[at:to] = run.ranges(self.starts[at:to] - low, self.ends[at:to] - low)
            at = to

    def blocks(self, width: int) -> np.ndarray:
        """Hash of the ``width`` (1 or 2) words ending at each word; the first of 2 has no block and holds its own word's."""
        out = self.hashes.copy()
        if width == 2:
            out[1:] = C.mix64(self.hashes[1:] + _MIX * self.hashes[:-1])
        return out


class WuManber:
    """Tables for the patterns of one length: flat arrays over one buffer of the items' words.

    ``shift`` is addressed by the top bits of a block's hash and holds the smallest jump of the blocks that
    share a place, so that no occurrence is passed.  Patterns are the word offsets where they end, sorted by
    suffix block and first word; their bytes stand in the buffer for the direct comparison."""

    def __init__(self, length: int, items: list[tuple[str | None, bytes]]):
        self.length, self.block = length, min(2, length)
        default = length - self.block + 1
        sizes = np.array([body.count(b" ") + 1 for _, body in items], dtype=np.int64)
        self.names = [name for name, _ in items]
        self.item_ends = np.cumsum(sizes)
        text = Words(b" ".join(body for _, body in items))
        self.body = text.body
        self.starts, self.ends = (x.astype(np.uint32) for x in (text.starts, text.ends))
        blocks = text.blocks(self.block)
        place = np.arange(len(blocks)) - np.repeat(self.item_ends - sizes, sizes)  # of a word in its item
        self.bits = min(24, max(8, len(blocks).bit_length() + 4))
        shift = np.full(1 << self.bits, default, dtype=np.uint8)
        inside = place >= self.block - 1
        np.minimum.at(shift, (blocks[inside] >> np.uint64(64 - self.bits)).astype(np.int64),
                      np.maximum(0, length - 1 - place[inside]).astype(np.uint8))
        self.shift = shift.tobytes()
        last = np.flatnonzero(place >= length - 1)
        keys = self.bucket_keys(text, blocks, last)
        order = np.argsort(keys, kind="stable")
        self.keys, self.last = keys[order], last[order].astype(np.uint32)

    def bucket_keys(self, text: Words, blocks: np.ndarray, last: np.ndarray) -> np.ndarray:
        return C.mix64(blocks[last] + _MIX * text.hashes[last - (self.length - 1)])

    def memory(self) -> int:
        return len(self.shift) + len(self.body) + sum(x.nbytes for x in (self.starts, self.ends, self.keys, self.last, self.item_ends))

    def scan(self, text: Words) -> Iterator[tuple[int, int, set]]:
        m, n = self.length, len(text.hashes)
        if n < m:
            return
        blocks = text.blocks(self.block)
        shift, stops = self.shift, []
        cells = (blocks >> np.uint64(64 - self.bits)).tolist()
        pos = m - 1
        while pos < n:
            jump = shift[cells[pos]]
            if jump:
                pos += jump
            else:
                stops.append(pos)
                pos += 1
        if not stops:
            return
        last = np.array(stops, dtype=np.int64)
        keys = self.bucket_keys(text, blocks, last)
        low = np.searchsorted(self.keys, keys)
        low[low == len(self.keys)] = 0
        met = self.keys[low] == keys
        known: dict[bytes, set] = {}
        for pos, at, key in zip(last[met].tolist(), low[met].tolist(), keys[met], strict=True):
            start = pos - m + 1
            own = text.body[text.starts[start]:text.ends[pos]]
            if own not in known:
                known[own] = self.holders(own, at, int(np.searchsorted(self.keys, key, side="right")))
            if known[own]:
                yield start, pos + 1, known[own]

    def holders(self, own: bytes, low: int, high: int) -> set:
        """Items of the bucket's patterns that are these words."""
        ends = self.last[low:high].astype(np.int64)
        same = [e for e in ends.tolist() if self.body[self.starts[e - self.length + 1]:self.ends[e]] == own]
        return {self.names[i] for i in np.searchsorted(self.item_ends, same, side="right").tolist()} if same else set()


def build_tables(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, list] = {}
    for item, text in items:
        if body := normal(text):
            by_length.setdefault(min(window, body.count(b" ") + 1), []).append((item, body))
    return [WuManber(m, own) for m, own in by_length.items()]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan_block(docs: DataFrame, tables, text_col: str, first: bool) -> DataFrame:
    schema = C.with_fields(docs, OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wms = tables.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            before = [([], [])] * len(texts)
            if not first:
                before = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                    for c in ("hit_spans", "hit_items")), strict=True))
            n_words, spans_out, items_out = [], [], []
            for text, (old, old_items) in zip(texts, before, strict=True):
                words = Words(normal(text))
                spans, items = list(zip(old[::2], old[1::2], strict=True)), set(old_items)
                for wm in wms:
                    for a, b, found in wm.scan(words):
                        spans.append((a, b))
                        items |= found
                items.discard(None)
                n_words.append(len(words.hashes))
                spans_out.append([x for s in merge_spans(spans) for x in s])
                items_out.append(sorted(items))
            yield C.append_columns(batch, schema, {"n_words": n_words, "hit_spans": spans_out, "hit_items": items_out})

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (flat start,end word offsets, merged) and ``hit_items`` (sorted ids)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    out = docs
    for b in range(blocks):
        if b:  # one block's tables at a time on the workers
            out = C.persisted(out, "decontamination-block")
            tables.unpersist()
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        tables = spark.sparkContext.broadcast(build_tables([tuple(r) for r in part.collect()], window))
        out = _scan_block(out, tables, text_col, first=b == 0)
    return out


def hit_words():
    """Column: number of words inside an occurrence, from ``hit_spans``."""
    ends = F.filter("hit_spans", lambda _, i: i % 2 == 1)
    starts = F.filter("hit_spans", lambda _, i: i % 2 == 0)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return total(ends) - total(starts)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` with no occurrence of any window, columns unchanged."""
    marked = find_contamination(docs.withColumn("_own", F.struct(*docs.columns)), benchmark, **options)
    return marked.where(F.size("hit_spans") == 0).select("_own.*")
