"""Token ids of whole texts by the tokenizers library, for use inside Arrow tasks.

Byte-level BPE never joins characters across the start of a space that precedes
a non-space, nor across a lone line break between non-spaces.  Texts are cut
there, each distinct piece is encoded once by the tokenizer and then looked up;
a text with any other run of white space, or that spells out an added token
such as ``<|endoftext|>``, goes to the tokenizer whole.  The
piece table is a bounded cache per Python worker, it never changes a result.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np

# No space before what follows (a piece's leading space is implied otherwise).
_BARE = "\x01"
_BREAK = " \x01\n \x01"
_ODD = re.compile(r"[ \n](?:\s|\Z)|\A\s|\x01")
# letters, then a run of ASCII marks without the apostrophe, which may start a contraction
_WORD_MARKS = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
# different runs of marks kept by a worker
MARK_RUNS = 4096
_KNOWN, _WORD, _REST = range(3)
END_ID = 0


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.uint32, count=int(sizes.sum())), sizes


def _slices(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The given slices of ``flat``, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]


class OddSpace(Exception):
    """A text has a run of white space that pieces cannot express."""


class Pieces(dict):
    """piece -> row; a new piece gets the next row and is noted in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        if not piece[:1].isalpha():
            body = piece[1:] if piece[:1] == _BARE else piece
            if piece != "\x01\n" and (not body or body[0].isspace()):
                raise OddSpace
        row = self[piece] = len(self)
        self.fresh.append(piece)
        return row


class PieceEncoder:
    """``encode(texts)`` -> ids per text, those of ``encode(text, add_special_tokens=False)``.

    ``lead_space`` encodes space + text instead and takes added tokens' spellings as plain text."""

    def __init__(self, path: str, capacity: int = 350_000, lead_space: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Split

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = lead_space
        self.lead = " " if lead_space else ""
        self.first = "" if lead_space else _BARE
        # texts that hold an added token's own spelling are encoded whole
        added = [] if lead_space else self.tok.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        # the printable stand-in of each byte, as the model sees words
        self.letters = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        self.letters |= {b: level.pre_tokenize_str(chr(c))[0][0][i] for c in range(0x80, 0x800) for i, b in enumerate(chr(c).encode())}
        self.letters |= {b: self._stand_in(level, b) for b in range(0xE0, 0xF5)}
        self.capacity = capacity
        # the same model with nothing before it but a cut at line breaks
        self.words = Tokenizer(self.tok.model)
        self.words.pre_tokenizer = Split(self.letters[10], "isolated")
        self.line_break = self.tok.token_to_id(self.letters[10])
        self.pieces, self.marks = Pieces(), {"": 0}
        self.flat, self.mark_flat = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.uint32)
        self.starts, self.sizes, self.hits, self.mark_sizes = (np.zeros(0, dtype=np.int64) for _ in range(4))

    @staticmethod
    def _stand_in(level, lead: int) -> str:
        text = bytes([lead, *([0xA0, 0x80] if lead < 0xF0 else [0x90 if lead == 0xF0 else 0x80, 0x80, 0x80])])
        if lead == 0xED:
            text = bytes([lead, 0x80, 0x80])
        return level.pre_tokenize_str(text.decode())[0][0][0]

    def raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _model_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one word after another, ids per word): one call of the model, words held apart by line breaks."""
        if not words:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        text = ("\n".join(words) + "\n").encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
        breaks = np.flatnonzero(ids == self.line_break)
        return np.delete(ids, breaks), np.diff(breaks, prepend=-1) - 1

    def _piece_ids(self, fresh: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one piece after another, ids per piece).

        A word (and marks after it) goes straight to the model, once with and without marks; all else goes
        through the whole tokenizer."""
        known, words, rest, match = len(self.sizes), {}, [], _WORD_MARKS.fullmatch
        if len(self.marks) > MARK_RUNS:
            self.marks = {"": 0}
        marks, n_marks = self.marks, len(self.marks)
        kind, place, tail = [], [], []
        for p in fresh:
            if p.isalpha():  # most are a word alone
                kind.append(_WORD)
                place.append(words.setdefault(" " + p, len(words)))
                tail.append(0)
                continue
            bare = p[:1] == _BARE
            m = match(p, 1) if bare else match(p)
            if m and m[1].isalpha():
                row = self.pieces.get(p[:m.end(1)], known) if m[2] else known
                if row < known:
                    kind.append(_KNOWN)
                    place.append(row)
                else:
                    kind.append(_WORD)
                    place.append(words.setdefault(m[1] if bare else " " + m[1], len(words)))
                tail.append(marks.setdefault(m[2], len(marks)))
            else:
                kind.append(_REST)
                place.append(len(rest))
                tail.append(0)
                rest.append(p[1:] if bare else " " + p)
        if len(marks) > n_marks or not self.mark_sizes.size:
            flat, sizes = _joined(self.raw([*marks]))
            self.mark_flat, self.mark_sizes = flat, sizes
        word_flat, word_sizes = self._model_ids([*words])
        rest_flat, rest_sizes = _joined(self.raw(rest))
        # each piece is two slices of one buffer: its word, then its marks
        parts = [self.flat, word_flat, rest_flat, self.mark_flat]
        base = np.cumsum([0, *map(len, parts)])
        starts = [self.starts + base[0]] + [np.cumsum(n) - n + at for n, at in
                                            zip((word_sizes, rest_sizes, self.mark_sizes), base[1:], strict=False)]
        sizes = [self.sizes, word_sizes, rest_sizes, self.mark_sizes]
        first = np.cumsum([0, *map(len, sizes)])
        at = np.empty((len(fresh), 2), dtype=np.int64)
        at[:, 0] = first[np.array(kind)] + np.array(place)
        at[:, 1] = first[3] + np.array(tail)
        n = np.concatenate(sizes)[at]
        return _slices(np.concatenate(parts), np.concatenate(starts)[at].ravel(), n.ravel()), n.sum(axis=1)

    def _learn(self) -> None:
        fresh, self.pieces.fresh = self.pieces.fresh, []
        flat, sizes = self._piece_ids(fresh)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.hits = np.concatenate([self.hits, np.zeros(len(sizes), dtype=np.int64)])
        self.flat = np.concatenate([self.flat, flat])

    def _trim(self) -> None:
        """Drop pieces met once; if that is not enough, all but the most frequent third."""
        keep = self.hits > 1
        if keep.sum() > self.capacity // 2:
            keep = self.hits > np.partition(self.hits, -self.capacity // 3)[-self.capacity // 3]
        rows = np.flatnonzero(keep)
        sizes = self.sizes[rows]
        self.flat = _slices(self.flat, self.starts[rows], sizes)
        self.starts, self.sizes, self.hits = np.cumsum(sizes) - sizes, sizes, self.hits[rows] // 2 + 1
        names, self.pieces = list(self.pieces), Pieces()
        self.pieces.update(zip([names[i] for i in rows.tolist()], range(len(rows)), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.pieces) > self.capacity:
            self._trim()
        try:
            return self._encode(texts, [i for i, t in enumerate(texts) if t and _BARE not in t and not self.added.search(t)])
        except OddSpace:
            return self._encode(texts, [i for i, t in enumerate(texts) if t and not _ODD.search(t) and not self.added.search(t)])

    def _encode(self, texts: list[str], plain: list[int]) -> list[np.ndarray]:
        cut = [(self.first + texts[i].replace("\n", _BREAK)).split(" ") for i in plain]
        counts = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        try:
            at = np.fromiter(map(self.pieces.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(counts.sum()))
        finally:
            if self.pieces.fresh:
                self._learn()
        self.hits += np.bincount(at, minlength=len(self.hits))
        n = self.sizes[at]
        ends = np.cumsum(n)
        ids = _slices(self.flat, self.starts[at], n)
        out: list[np.ndarray | None] = [None] * len(texts)
        done = 0
        for i, last in zip(plain, np.cumsum(counts).tolist(), strict=True):
            end = int(ends[last - 1])
            out[i] = ids[done:end]
            done = end
        direct = [i for i, x in enumerate(out) if x is None]
        for i, own in zip(direct, self.raw([self.lead + texts[i] for i in direct]), strict=True):
            out[i] = np.asarray(own, dtype=np.uint32)
        return out


@cache
def encoder(path: str, capacity: int) -> PieceEncoder:
    return PieceEncoder(path, capacity)


def doc_ids(texts: list[str | None], path: str, run_chars: int = 1 << 20, capacity: int = 350_000):
    """Yield (index, uint32 ids with the end id) per text, encoding about ``run_chars`` characters at a time.

    ``capacity`` bounds the pieces a worker keeps (some 250 bytes each)."""
    from shelfcast.llm.common import text_runs

    texts = [t or "" for t in texts]
    enc = encoder(path, capacity)
    for a, b in text_runs([len(t) for t in texts], run_chars):
        for i, ids in enumerate(enc.encode(texts[a:b]), start=a):
            yield i, np.append(ids, np.uint32(END_ID))
