"""Homomorphic multiset hash of a text's paragraphs.

Every paragraph (line) becomes a wide vector; the fingerprint is the sum of the
vectors.  It does not depend on paragraph order, and inserting or deleting a
paragraph adds or subtracts its vector.  The vector has two groups of lanes:

* 8 lanes modulo 2^64 from a 512-bit digest of the paragraph: two texts agree
  on them only if they hold the same paragraphs as often;
* 512 lanes modulo 2^32 (a text under 2 GB has fewer than 2^30 shingles) that count the paragraph's three-word shingles, each
  hashed to a lane and a sign: the cosine of two fingerprints' lanes estimates
  the share of shingles the texts have in common, which is their likeness.

Edge cases: null counts as the empty text (one empty paragraph); paragraphs
under three words are one shingle; equal texts have equal fingerprints; rows
with equal ids are ordered by a hash of their text, identical rows may stand in
either order; a table of one row is its own next; an empty table gives no row;
other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm.ordered import OWN, with_neighbours

WIDE, LANES, SHINGLE = 8, 512, 3
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def vector(text: str) -> np.ndarray:
    """Sum of the paragraph vectors of ``text``: WIDE lanes modulo 2^64, then LANES lanes modulo 2^32."""
    data = text.encode("utf-8", "surrogatepass")
    out = np.zeros(WIDE + LANES, dtype=np.uint64)
    digests = b"".join(hashlib.blake2b(p, digest_size=8 * WIDE).digest() for p in data.split(b"\n"))
    out[:WIDE] = np.frombuffer(digests, dtype="<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if len(starts):
        line = np.concatenate([[0], np.cumsum(raw == 10)])[starts]
        first = np.searchsorted(line, line)
        last = np.searchsorted(line, line, side="right") - 1
        at = np.arange(len(starts))
        stop = at + SHINGLE - 1
        use = (stop <= last) | (at == first)
        stop = np.minimum(stop, last)
        h = C.PrefixHash(raw).ranges(starts[use], ends[stop[use]])
        sign = np.where(h >> np.uint64(63), 1.0, -1.0)
        lanes = np.bincount((h % np.uint64(LANES)).astype(np.int64), weights=sign, minlength=LANES)
        out[WIDE:] = lanes.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF)
    return out


def add(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprint of the union (or, with -1, the difference) of two paragraph multisets."""
    out = a + b if sign > 0 else a - b
    out[WIDE:] &= np.uint64(0xFFFFFFFF)
    return out


def render(v: np.ndarray) -> str:
    return base64.b64encode(v[:WIDE].astype("<u8").tobytes() + v[WIDE:].astype("<u4").tobytes()).decode()


def parse(fingerprint: str) -> np.ndarray:
    data = base64.b64decode(fingerprint)
    return np.concatenate([np.frombuffer(data[:8 * WIDE], "<u8"), np.frombuffer(data[8 * WIDE:], "<u4").astype(np.uint64)]).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal multisets, else the estimated cosine of their shingle counts, not below 0."""
    if np.array_equal(a, b):
        return 1.0
    x, y = (v[WIDE:].astype(np.uint32).view(np.int32).astype(np.float64) for v in (a, b))
    norm = float(np.sqrt((x @ x) * (y @ y)))
    return min(1.0, max(0.0, float(x @ y) / norm)) if norm else 0.0


def edit_end(text: str, vec: np.ndarray, cut: int, new: str) -> tuple[str, np.ndarray]:
    """Replace ``text[cut:]`` by ``new``: only the paragraphs from the cut on are subtracted and added again."""
    line = text.rfind("\n", 0, cut) + 1
    edited = text[:cut] + new
    return edited, add(add(vec, vector(text[line:]), -1), vector(edited[line:]))


def fingerprints(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint string of each text."""
    @F.pandas_udf("string")
    def fp(texts):
        return texts.map(lambda t: render(vector(t or "")))

    return docs.withColumn(name, fp(text_col))


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = 16 << 20) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter is replaced from the next document's start."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("h", F.xxhash64("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lined = with_neighbours(src, ["doc_id", "h"], max(1, -(-size // part_bytes)), cyclic=True)
    names = [f.split()[0] for f in EDITED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = []
            for doc_id, text, part, side in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                vec = vector(text)
                if held and held[2] == part:
                    rows.append(_compare(held, text, vec))
                held = (doc_id, text, part, vec) if side == OWN else None
            if rows:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return lined.select("doc_id", "text", "_range", "_side").mapInArrow(run, EDITED)


def _compare(held: tuple, text: str, vec: np.ndarray) -> tuple:
    doc_id, old, _, old_vec = held
    n = len(old) // 4
    edited, edited_vec = edit_end(old, old_vec, len(old) - n, text[:n]) if n else (old, old_vec)
    return (doc_id, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), render(old_vec), render(edited_vec),
            likeness(old_vec, edited_vec), likeness(old_vec, vec))
