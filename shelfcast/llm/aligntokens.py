"""Alignment of two tokenizers' ids over the same text, and how often ids are linked corpus-wide.

Tokenizer A is a byte-level BPE of the tokenizers library, B a SentencePiece
model with byte fallback.  Both tokenise the whole text (a leading space is part
of it, B adds it itself).  Byte offsets where tokens of both end cut the tokens
into groups, and the two tokens that end there are linked.

Whitespace-token anchors: an offset where tokens of both end, and the next token
of both is space-marked, is a verified anchor.  Anchors split a document into
windows of (A ids, B ids); a window's groups and links follow from its ids alone,
so each worker aligns a window's id tuple once and looks it up afterwards (the
memo is bounded and never changes a result).

Corpus counts: linked tokens end together, so the bytes of one are a suffix of
the other's.  The number of different linked pairs is therefore at most the summed
byte lengths of both vocabularies, twice, whatever the corpus (``pair_bound``);
only that table is sent to the workers.  Links are written once per document as
pair codes and counted from that table, no text is tokenised twice.

Defined results: a text that is null or empty, or whose joined token bytes of A or
of B differ from space + text (B drops or changes characters), has no tokens: zeros and an
empty ``groups``.  Repeated rows count as often as they stand there.  An empty table
gives an empty result.  Clashing input columns give way to the new ones.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C
from shelfcast.llm.tokens import PieceEncoder, tokenizer_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
# characters handed to the tokenizers at a time, and the length from which one text is cut
RUN_CHARS = 1 << 19
PIECE_CACHE = 350_000
WINDOW_CACHE = 400_000
_MARK = np.uint32(0xFFFFFFFF)
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """Printable stand-in of each byte in a byte-level vocabulary -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary_bytes(path_a: str, path_b: str) -> tuple[list[bytes], list[bytes], set[int]]:
    """Bytes of every id of A and of B, and B's ids of byte pieces."""
    import sentencepiece
    from tokenizers import Tokenizer

    letters = byte_letters()
    tok = Tokenizer.from_file(path_a)
    a = [b""] * tok.get_vocab_size()
    for piece, i in tok.get_vocab().items():
        a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
    sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
    b, single = [], set()
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            single.add(i)
            b.append(bytes([int(piece[3:5], 16)]))
        else:
            b.append(piece.replace(SPACE, " ").encode())
    return a, b, single


@cache
def pair_bound(path_a: str, path_b: str) -> int:
    """How many different (A id, B id) can be linked: one's bytes end the other's; equal bytes have two B ids at most."""
    a, b, _ = vocabulary_bytes(path_a, path_b)
    return 2 * (sum(map(len, a)) + sum(map(len, b)))


class Memo:
    """Bounded table of two halves: what is asked for again moves to the newer half, the older one is dropped."""

    def __init__(self, capacity: int):
        self.half, self.new, self.old = capacity // 2, {}, {}

    def find(self, keys: list[bytes]) -> list:
        """The value of each key, None where there is none."""
        if len(self.new) > self.half:
            self.new, self.old = {}, self.new
        known = [*map(self.new.get, keys)]
        if self.old and None in known:
            for w, found in enumerate(known):
                if found is None and (found := self.old.get(keys[w])) is not None:
                    known[w] = self.new[keys[w]] = found
        return known


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = PieceEncoder(path_a, PIECE_CACHE, lead_space=True)
        # a byte-level vocabulary with all single bytes and no normalizer spells every text
        self.lossless = self.a.tok.normalizer is None and all(self.a.tok.token_to_id(c) is not None for c in byte_letters())
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes, self.b_bytes, _ = vocabulary_bytes(path_a, path_b)
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_space = np.array([x[:1] == b" " for x in self.a_bytes])
        self.b_space = np.array([x[:1] == b" " for x in self.b_bytes])
        self.memo = Memo(WINDOW_CACHE)
        self.names = np.array([*map(str, range(max(len(self.a_len), len(self.b_len))))], dtype=object)

    def encode_b(self, text: str) -> np.ndarray:
        """B's ids; a long text is cut before lone spaces, which no piece of B crosses and which B puts back."""
        if len(text) <= RUN_CHARS:
            return np.array(self.b.encode(text), dtype=np.uint32)
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + RUN_CHARS)
            end = cut.start() if cut else len(text)
            out.append(np.array(self.b.encode(text[at:end]), dtype=np.uint32))
            at = end + 1 if cut else end
        return np.concatenate(out)

    def ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) per text, both empty where either does not spell space + text."""
        nothing = np.zeros(0, dtype=np.uint32)
        short = [i for i, t in enumerate(texts) if 0 < len(t) <= RUN_CHARS]
        known = dict(zip(short, self.b.encode([texts[i] for i in short], num_threads=1), strict=True)) if short else {}
        for i, (text, a) in enumerate(zip(texts, self.a.encode(texts), strict=True)):
            if not text:
                yield nothing, nothing
                continue
            b = np.array(known.pop(i), dtype=np.uint32) if i in known else self.encode_b(text)
            whole = (" " + text).encode()
            same = self.spells(self.b_bytes, b, whole) and (self.lossless or self.spells(self.a_bytes, a, whole))
            yield (a, b) if same else (nothing, nothing)

    @staticmethod
    def spells(pieces: list[bytes], ids: np.ndarray, whole: bytes) -> bool:
        return b"".join(map(pieces.__getitem__, ids.tolist())) == whole

    def aligned(self, ids: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[str, bytes]]:
        """(groups, link codes) per document of a run."""
        sizes_a, sizes_b = (np.array([len(x[side]) for x in ids], dtype=np.int64) for side in (0, 1))
        if not sizes_a.sum():
            return [("", b"")] * len(ids)
        a, b = (np.concatenate([x[side] for x in ids]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        # verified anchors: both end there, and both go on with a space-marked token or the document ends
        before_a, before_b = np.append(self.a_space[a[1:]], True), np.append(self.b_space[b[1:]], True)
        before_a[np.cumsum(sizes_a)[sizes_a > 0] - 1] = True
        before_b[np.cumsum(sizes_b)[sizes_b > 0] - 1] = True
        here = np.zeros(int(ends_b[-1]) + 1, dtype=bool)
        here[ends_b[before_b]] = True
        stop_a = np.flatnonzero(here[ends_a] & before_a) + 1
        stop_b = np.searchsorted(ends_b, ends_a[stop_a - 1]) + 1
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        # one buffer of A ids, mark, B ids per window, so that a window's key is one slice
        stop = np.cumsum(n_a + n_b + 1)
        start = stop - (n_a + n_b + 1)
        buffer = np.full(int(stop[-1]), _MARK, dtype=np.uint32)
        buffer[np.repeat(start - (stop_a - n_a), n_a) + np.arange(len(a))] = a
        buffer[np.repeat(start + n_a + 1 - (stop_b - n_b), n_b) + np.arange(len(b))] = b
        raw = buffer.tobytes()
        keys = [raw[x:y] for x, y in zip((4 * start).tolist(), (4 * stop).tolist(), strict=True)]
        known = self.memo.find(keys)
        first = {}
        for w, found in enumerate(known):
            if found is None:
                first.setdefault(keys[w], w)
        if first:
            new = np.zeros(len(keys), dtype=bool)
            new[list(first.values())] = True
            rows = self.align_windows(a[np.repeat(new, n_a)], b[np.repeat(new, n_b)], n_b[new])
            fresh = dict(zip(first, rows, strict=True))
            self.memo.new.update(fresh)
            known = [fresh[keys[w]] if found is None else found for w, found in enumerate(known)]
        out, at = [], 0
        for size, end in zip(sizes_a.tolist(), (np.searchsorted(stop_a, np.cumsum(sizes_a)) + 1).tolist(), strict=True):
            if not size:
                out.append(("", b""))
                continue
            out.append((";".join([w[0] for w in known[at:end]]), b"".join([w[1] for w in known[at:end]])))
            at = end
        return out

    def align_windows(self, a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> list[tuple[str, bytes]]:
        """Windows one after another, each with ``n_b`` tokens of B: (groups, link codes) of each."""
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        mark_a, mark_b = (np.zeros(int(ends_a[-1]) + 1, dtype=bool) for _ in range(2))
        mark_a[ends_a] = mark_b[ends_b] = True
        cut_a, cut_b = mark_b[ends_a], mark_a[ends_b]
        codes = a[cut_a].astype(np.uint32) * np.uint32(len(self.b_len)) + b[cut_b]
        # a group's tokens of A stand before its tokens of B
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        done_a, done_b = np.flatnonzero(cut_a) + 1, np.append(0, np.flatnonzero(cut_b) + 1)
        place_a, place_b = np.arange(len(a)) + done_b[group_a], np.arange(len(b)) + done_a[group_b]
        last = np.cumsum(n_b) - 1
        text = np.empty(2 * (len(a) + len(b)), dtype=object)
        text[2 * place_a], text[2 * place_b] = self.names[a], self.names[b]
        text[2 * place_a + 1] = np.where(cut_a, "|", ",").astype(object)
        tail = np.where(cut_b, ";", ",").astype(object)
        tail[last] = "\n"
        text[2 * place_b + 1] = tail
        groups = "".join(text.tolist()).split("\n")
        raw, stop = codes.astype("<u4").tobytes(), (4 * (group_b[last] + 1)).tolist()
        return [(g, raw[x:y]) for g, x, y in zip(groups[:-1], [0, *stop[:-1]], stop, strict=True)]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


COUNTS = [T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
          T.StructField("n_links", T.LongType())]
SHA = T.StructField("groups_sha256", T.StringType())
GROUPS = T.StructField("groups", T.StringType())
CODES = T.StructField("link_codes", T.BinaryType())


def align(docs: DataFrame, with_groups: bool = True, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, groups_sha256, link_codes (little-endian uint32, A id * size of B + B id, in
    text order) and, where asked for, ``groups`` itself."""
    path_a, path_b = path_a or tokenizer_path(A_FILE), path_b or tokenizer_path(B_FILE)
    extra = [*COUNTS, SHA, CODES] + ([GROUPS] if with_groups else [])
    schema = C.with_fields(docs, extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for whole in batches:
            texts = [t or "" for t in whole.column(whole.schema.get_field_index("text")).to_pylist()]
            for lo, hi in C.text_runs([len(t) for t in texts], RUN_CHARS):
                new: dict[str, list] = {f.name: [] for f in extra}
                ids = [*tool.ids(texts[lo:hi])]
                for (a, b), (groups, codes) in zip(ids, tool.aligned(ids), strict=True):
                    new["n_a"].append(len(a))
                    new["n_b"].append(len(b))
                    new["n_groups"].append(len(codes) // 4)
                    new["n_links"].append(len(codes) // 4)
                    new["groups_sha256"].append(hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                    new["link_codes"].append(codes)
                    if with_groups:
                        new["groups"].append(groups)
                yield C.append_columns(whole.slice(lo, hi - lo), schema, new)

    return docs.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, n): links per id pair over all rows; each task sums its own rows first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        for batch in batches:
            new = np.frombuffer(b"".join(x for x in batch.column(0).to_pylist() if x), dtype="<u4")
            own, n = np.unique(new, return_counts=True)
            codes, back = np.unique(np.concatenate([codes, own]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts)], names=["code", "n"])

    partial = aligned.select("link_codes").mapInArrow(run, "code long, n long")
    return partial.groupBy("code").agg(F.sum("n").alias("n"))


LINKED = [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]


def with_link_counts(aligned: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``aligned`` with n_best (links whose pair is the most frequent of its B id, ties included) and count_sum."""
    path_a, path_b = path_a or tokenizer_path(A_FILE), path_b or tokenizer_path(B_FILE)
    bound = pair_bound(path_a, path_b)
    n_b = len(vocabulary_bytes(path_a, path_b)[1])
    rows = pair_counts(aligned).toPandas()
    if len(rows) > bound:
        raise ValueError(f"{len(rows)} linked pairs, the vocabularies allow {bound}")
    rows = rows.sort_values("code")
    code, n = rows["code"].to_numpy(np.uint32), rows["n"].to_numpy(np.int64)
    best = np.zeros(n_b, dtype=np.int64)
    np.maximum.at(best, code % n_b, n)
    table = aligned.sparkSession.sparkContext.broadcast((code, n, n == best[code % n_b]))
    schema = C.with_fields(aligned, LINKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, top = table.value
        for batch in batches:
            n_best, count_sum = [], []
            for raw in batch.column(batch.schema.get_field_index("link_codes")).to_pylist():
                at = np.searchsorted(code, np.frombuffer(raw or b"", dtype="<u4"))
                n_best.append(int(top[at].sum()))
                count_sum.append(int(n[at].sum()))
            yield C.append_columns(batch, schema, {"n_best": n_best, "count_sum": count_sum})

    return aligned.mapInArrow(run, schema)


def corpus_alignment(docs: DataFrame, with_groups: bool = False, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Every row of ``docs`` aligned, with its links judged by the counts of the whole corpus."""
    slim = docs if with_groups else docs.drop("text")
    aligned = align(docs, with_groups, path_a, path_b).drop(*([] if with_groups else ["text"]))
    written = C.persisted(aligned, "align")
    done = with_link_counts(written, path_a, path_b)
    return done.select(*[c for c in slim.columns if c in done.columns], *[c for c in done.columns if c not in slim.columns and c != "link_codes"])
