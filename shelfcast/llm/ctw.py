"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions; a decision's node is (the last d bytes,
the bits of this byte so far) for every depth d from 0 to ``depth``.  A node
holds the counts of zeros and ones in the training texts and estimates by
Krichevsky-Trofimov.  Weighting mixes all depths: P_w = (P_kt + product of the
children's P_w) / 2, so a node's share against its children's is its posterior;
a bit's probability is the mixture down its context path.  Where a context was
not seen in training the rest of the mixture stays with the deepest node that
was.  A text ends with one end symbol, which is scored too.

As Spark jobs: texts are dealt to blocks of bounded bytes by a hash; each block
lists its distinct (context, byte) grams and words with training counts; counts
are summed over blocks, so what is gathered grows with the corpus; the tree is
solved per range of contexts (subtrees under the two nearest bytes are
independent, the at most 65,536 nodes of depth one meet on the driver); the log
probabilities and word counts a block asked for are joined back and sorted
before its texts, which pass one by one.  No task holds the model, only what its
block asked for (16 bytes a gram), and long texts are cut into slices.  A word is
asked for unless its count follows from the text at hand: words seen once in
training, in the block's training texts alone, and words never seen.

The base score is the add-one unigram of the words and the end token.

Edge cases: null counts as empty (the end alone); repeated rows are scored, and
learned from, row by row; a null id is learned from and not held out; with no
training row every bit has probability one half; an empty table gives no row;
other input columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common as C

DEPTH = 5
BLOCK_BYTES = 36 << 20
SLICE = 1 << 20
MARK = 0xFF  # in no UTF-8 text: padding before the start and the end symbol
GRAM, WORD, TEXT = 0, 1, 2  # what a row of a block holds, in the order a task reads them
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln(gamma(x)) for x >= 0.5, by Stirling's series after seven steps of the recurrence."""
    shift = np.zeros_like(x)
    for i in range(7):
        shift += np.log(x + i)
    z = x + 7
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def log_mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln((e^a + e^b) / 2)."""
    return np.logaddexp(a, b) - np.log(2)


def gram_keys(parts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, part number) of every byte after a part's first ``depth``; a key is the context, nearest byte first, then the byte."""
    raw = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) - depth
    owner = np.repeat(np.arange(len(parts)), size)
    at = np.arange(len(owner)) + depth * (owner + 1)
    key = np.zeros(len(owner), dtype=np.uint64)
    for d in range(1, depth + 1):
        key = (key << np.uint64(8)) | raw[at - d]
    return (key << np.uint64(8)) | raw[at], owner


def gram_slices(bodies: list[bytes], depth: int, limit: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, text number) of every byte and end symbol, at most about ``limit`` at a time; long texts are cut."""
    parts, numbers, size = [], [], 0
    for i, body in enumerate(bodies):
        whole = bytes([MARK]) * depth + body + bytes([MARK])
        for a in range(0, len(body) + 1, limit):
            part = whole[a:a + limit + depth]
            if parts and size + len(part) > limit:
                key, owner = gram_keys(parts, depth)
                yield key, np.array(numbers)[owner]
                parts, numbers, size = [], [], 0
            parts.append(part)
            numbers.append(i)
            size += len(part)
    if parts:
        key, owner = gram_keys(parts, depth)
        yield key, np.array(numbers)[owner]


def word_slices(body: bytes, limit: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, those of some ``limit`` bytes at a time."""
    start = 0
    while start < len(body):
        gap = _SPACE.search(body, start + limit)
        end = gap.start() if gap else len(body)
        yield body[start:end].split()
        start = end


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[head], np.add.reduceat(counts, head) if len(head) else counts


class Level:
    """Nodes of one depth and bit position: counts per node, and the node of every (context, byte) entry."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, j: int):
        node = keys >> np.uint64(8 - j)
        self.head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        self.of = np.cumsum(np.concatenate([[False], node[1:] != node[:-1]]))
        bit = (keys >> np.uint64(7 - j)) & np.uint64(1)
        self.ones = np.add.reduceat(counts * bit, self.head).astype(np.float64)
        self.zeros = np.add.reduceat(counts, self.head).astype(np.float64) - self.ones
        self.seen = self.ones + self.zeros > 0
        self.log_kt = np.where(self.seen, log_kt(self.zeros, self.ones), 0.0)
        self.one = (self.ones + 0.5) / (self.ones + self.zeros + 1)


class Subtrees:
    """All nodes of depths ``top`` to ``depth`` under a set of whole depth-``top`` contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int):
        self.depth, self.top = depth, top
        self.entries = {depth: (keys, counts.astype(np.float64))}
        self.up = {}
        for d in range(depth - 1, top - 1, -1):
            deeper, n = self.entries[d + 1]
            short = ((deeper >> np.uint64(16)) << np.uint64(8)) | (deeper & np.uint64(0xFF))
            known, inverse = np.unique(short, return_inverse=True)
            self.entries[d] = (known, np.bincount(inverse, weights=n, minlength=len(known)))
            self.up[d + 1] = inverse
        self.levels = {(d, j): Level(*self.entries[d], j) for d in range(top, depth + 1) for j in range(8)}
        self.log_w = {}
        for j in range(8):
            for d in range(depth, top - 1, -1):
                level = self.levels[d, j]
                if d == depth:
                    self.log_w[d, j] = level.log_kt
                    continue
                below = self.levels[d + 1, j]
                parent = level.of[self.up[d + 1][below.head]]
                children = np.bincount(parent, weights=self.log_w[d + 1, j], minlength=len(level.head))
                self.log_w[d, j] = np.where(level.seen, log_mix(level.log_kt, children), 0.0)

    def top_nodes(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(context and bits so far, ln P_w, zeros, ones) of the seen depth-``top`` nodes, bit position by position."""
        keys = self.entries[self.top][0]
        for j in range(8):
            level = self.levels[self.top, j]
            first = keys[level.head]
            prefix = (np.uint64(1) << np.uint64(j)) | ((first & np.uint64(0xFF)) >> np.uint64(8 - j))
            node = ((first >> np.uint64(8)) << np.uint64(8)) | prefix
            yield node[level.seen], self.log_w[self.top, j][level.seen], level.zeros[level.seen], level.ones[level.seen]

    def log10_grams(self, above: np.ndarray) -> np.ndarray:
        """log10 P(byte | context) per entry of the deepest level; ``above`` is the state table of depth ``top - 1``."""
        keys = self.entries[self.depth][0]
        total = np.zeros(len(keys))
        for j in range(8):
            level = self.levels[self.top, j]
            first = self.entries[self.top][0][level.head]
            prefix = (np.uint64(1) << np.uint64(j)) | ((first & np.uint64(0xFF)) >> np.uint64(8 - j))
            # the parent context drops the farthest byte
            state = above[:, (((first >> np.uint64(16)) << np.uint64(8)) | prefix).astype(np.int64)]
            for d in range(self.top, self.depth + 1):
                level = self.levels[d, j]
                if d > self.top:
                    state = state[:, self.levels[d - 1, j].of[self.up[d][level.head]]]
                state = descend(state, level, self.log_w[d, j], last=d == self.depth)
            one = state[0] + state[1] * state[2]
            bit = ((keys >> np.uint64(7 - j)) & np.uint64(1)).astype(bool)
            p = one[level.of]
            total += np.log10(np.where(bit, p, 1 - p))
        return total


def descend(state: np.ndarray, level, log_w: np.ndarray, last: bool) -> np.ndarray:
    """State of a node from its parent's: (mixed probability of a one so far, mass left, estimate of the deepest seen node)."""
    mixed, left, deepest = state
    share = np.ones(len(log_w)) if last else np.exp(np.minimum(0.0, level.log_kt - np.log(2) - log_w))
    seen = level.seen
    return np.stack([np.where(seen, mixed + left * share * level.one, mixed), np.where(seen, left * (1 - share), left),
                     np.where(seen, level.one, deepest)])


class _Flat:
    """Depth-0 or depth-1 nodes as a full table (at most 65,536)."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray):
        self.zeros, self.ones = zeros, ones
        self.seen = zeros + ones > 0
        self.log_kt = np.where(self.seen, log_kt(zeros, ones), 0.0)
        self.one = (ones + 0.5) / (zeros + ones + 1)


def root_states(rows: list[tuple[int, float, float, float]]) -> np.ndarray:
    """State table of depth 1, indexed by byte << 8 | bits so far, from (node, sum of children's ln P_w, zeros, ones)."""
    children, zeros, ones = np.zeros((3, 1 << 16))
    for node, log_w, z, o in rows:
        children[node], zeros[node], ones[node] = log_w, z, o
    one = _Flat(zeros, ones)
    log_w1 = np.where(one.seen, log_mix(one.log_kt, children), 0.0)
    zero = _Flat(zeros.reshape(256, 256).sum(axis=0), ones.reshape(256, 256).sum(axis=0))
    log_w0 = np.where(zero.seen, log_mix(zero.log_kt, log_w1.reshape(256, 256).sum(axis=0)), 0.0)
    start = np.stack([np.zeros(256), np.ones(256), np.full(256, 0.5)])
    state = descend(start, zero, log_w0, last=False)
    return descend(np.tile(state, (1, 256)), one, log_w1, last=False)


# ---------------------------------------------------------------- Spark jobs

def held_out(id_col: str):
    """crc32 of the id as text, modulo 7, is 2; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


PAIRS = "block long, gram long, word binary, held boolean, n long"


def _emit(block: int, keys, words, held, counts, size: int = 100_000) -> Iterator[pa.RecordBatch]:
    n = len(counts)
    for a in range(0, n, size):
        b = min(n, a + size)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(b - a, block, dtype=np.int64)),
            pa.array(keys[a:b].view(np.int64)) if keys is not None else pa.nulls(b - a, pa.int64()),
            pa.array(words[a:b], pa.binary()) if words is not None else pa.nulls(b - a, pa.binary()),
            pa.array(held[a:b], pa.bool_()) if held is not None else pa.nulls(b - a, pa.bool_()),
            pa.array(counts[a:b], pa.int64())], names=["block", "gram", "word", "held", "n"])


class _BlockCounts:
    """Distinct grams and words of one block, with their training counts."""

    def __init__(self, block: int, depth: int):
        self.block, self.depth = block, depth
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.fresh, self.waiting = [], 0
        self.words, self.held = Counter(), set()

    def add(self, bodies: list[bytes], held: bool) -> None:
        for key, _ in gram_slices(bodies, self.depth):
            grams, n = np.unique(key, return_counts=True)
            self.fresh.append((grams, np.zeros_like(n) if held else n))
            self.waiting += len(grams)
            if self.waiting > SLICE:
                self.merge()
        for body in bodies:
            for words in word_slices(body):
                (self.held if held else self.words).update(words)

    def merge(self) -> None:
        grams, counts = zip((self.keys, self.counts), *self.fresh, strict=True)
        self.keys, self.counts = _sum_by_key(np.concatenate(grams), np.concatenate(counts))
        self.fresh, self.waiting = [], 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        yield from _emit(self.block, self.keys, None, None, self.counts)
        seen = list(self.words)
        yield from _emit(self.block, None, seen, [w in self.held for w in seen], list(self.words.values()))
        idle = list(self.held - self.words.keys())
        yield from _emit(self.block, None, idle, [True] * len(idle), [0] * len(idle))


def block_counts(texts: DataFrame, depth: int) -> DataFrame:
    """(block, gram, null, null, n) and (block, null, word, held, n): what each block holds, with its training
    counts; ``held`` says that a held-out text of the block has the word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            bodies = [b.lower() for b in batch.column(1).to_pylist()]
            held = batch.column(2).to_pylist()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if now is None or blocks[lo] != now.block:
                    if now is not None:
                        yield from now.rows()
                    now = _BlockCounts(int(blocks[lo]), depth)
                for out in (False, True):
                    now.add([b for b, h in zip(bodies[lo:hi], held[lo:hi], strict=True) if h == out], out)
        if now is not None:
            yield from now.rows()

    return texts.select("block", "body", "held_out").mapInArrow(run, PAIRS)


def _solve(totals: DataFrame, depth: int, top: int, schema: str, answer) -> DataFrame:
    """``answer(Subtrees)`` for whole depth-``top`` contexts, some 100,000 grams at a time."""
    near = F.shiftright("gram", 8 * (depth + 1 - top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.float64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)])
            counts = np.concatenate([counts, batch.column(1).to_numpy(zero_copy_only=False)])
            if len(keys) >= 100_000:
                context = keys >> np.uint64(8 * (depth + 1 - top))
                cut = int(np.searchsorted(context, context[-1]))  # the last context may go on
                if cut:
                    yield from answer(Subtrees(keys[:cut], counts[:cut], depth, top))
                    keys, counts = keys[cut:], counts[cut:]
        if len(keys):
            yield from answer(Subtrees(keys, counts, depth, top))

    return totals.withColumn("near", near).repartition("near").sortWithinPartitions("gram").select("gram", "n").mapInArrow(run, schema)


def gram_scores(pairs: DataFrame, depth: int) -> DataFrame:
    """(gram, value): log10 probability of the byte after its context, for every gram of the corpus."""
    spark, top = pairs.sparkSession, 2
    totals = C.persisted(pairs.where(F.col("word").isNull()).groupBy("gram").agg(F.sum("n").cast("double").alias("n")), "ctw-grams")

    def tops(tree: Subtrees) -> Iterator[pa.RecordBatch]:
        for node, log_w, zeros, ones in tree.top_nodes():
            # to depth one: drop the second byte
            parent = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(0xFF))
            yield pa.RecordBatch.from_arrays([pa.array(parent.astype(np.int64)), pa.array(log_w), pa.array(zeros), pa.array(ones)],
                                             names=["node", "log_w", "zeros", "ones"])

    nodes = _solve(totals, depth, top, "node long, log_w double, zeros double, ones double", tops)
    # depth-one nodes: at most 256 contexts x 255 bit positions
    rows = nodes.groupBy("node").agg(F.sum("log_w"), F.sum("zeros"), F.sum("ones")).collect()
    states = spark.sparkContext.broadcast(root_states([tuple(r) for r in rows]))

    def grams(tree: Subtrees) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(tree.entries[depth][0].view(np.int64)), pa.array(tree.log10_grams(states.value))],
                                         names=["gram", "value"])

    return _solve(totals, depth, top, "gram long, value double", grams)


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "bits_per_byte double")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document; training rows are those not held out by id."""
    if not 2 <= depth <= 6:
        raise ValueError("depth: 2 to 6 bytes")
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body"), held_out(id_col).alias("held_out"))
    sums = texts.agg(F.sum(F.octet_length("body")), F.count_if(~F.col("held_out"))).first()
    blocks = max(1, -(-(sums[0] or 0) // block_bytes))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "body"), F.lit(blocks)))
    dealt = texts.select("block", "body", "held_out").repartition("block").sortWithinPartitions("block")
    pairs = C.persisted(block_counts(dealt, depth), "ctw-pairs")
    C.release(spark)
    scores = gram_scores(pairs, depth)
    grams = C.persisted(pairs.where(F.col("word").isNull()).select("block", "gram").join(scores, "gram").select("block", "gram", "value"), "ctw-wanted")
    C.release(spark)
    words = pairs.where(F.col("word").isNotNull()).select("block", "word", "held", "n")
    totals = C.persisted(words.groupBy("word").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("blocks")), "ctw-words")
    C.release(spark)
    known = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = sums[1]
    n_train, distinct = known[0] + ends, known[1] + (ends > 0)
    # a word of one block has that block's count
    counted = words.join(totals.where("blocks > 1").select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", "n"))
    counted = counted.where((F.col("c") != F.col("n")) | (F.col("n") > 1) | ((F.col("n") == 1) & F.col("held")))

    def rows(df: DataFrame, kind: int, key, value, body) -> DataFrame:
        return df.select((F.col("block") * 4 + kind).alias("place"), key.cast("long").alias("key"), value.cast("double").alias("value"),
                         body.cast("binary").alias("body"))

    none = F.lit(None)
    stream = C.union_all([rows(grams, GRAM, F.col("gram"), F.col("value"), none), rows(counted, WORD, none, F.col("c"), F.col("word")),
                          rows(texts, TEXT, F.col("doc_id"), F.col("held_out").cast("int"), F.col("body"))])
    log_base, log_end = float(np.log10(n_train + distinct + 1)), float(np.log10(ends + 1))

    def scored(part: pa.RecordBatch, gram: np.ndarray, value: np.ndarray, count: dict[bytes, float]) -> pa.RecordBatch:
        bodies = [b.lower() for b in part.column("body").to_pylist()]
        held = [v > 0 for v in part.column("value").to_pylist()]
        n_tokens, n_known, base = [], [], []
        for body, out in zip(bodies, held, strict=True):
            n, seen, log_sum = 1, int(ends > 0), log_end
            for words in word_slices(body):
                # not asked for: seen once, in this training text, or never
                c = np.array([count.get(w, 0.0 if out else 1.0) for w in words])
                n, seen, log_sum = n + len(c), seen + int((c > 0).sum()), log_sum + float(np.log10(c + 1).sum())
            n_tokens.append(n)
            n_known.append(seen)
            base.append(log_sum - n * log_base)
        scores = np.zeros(len(bodies))
        for key, owner in gram_slices(bodies, depth):
            scores += np.bincount(owner, weights=value[np.searchsorted(gram, key)], minlength=len(bodies))
        sizes = np.fromiter(map(len, bodies), dtype=np.int64, count=len(bodies))
        return pa.RecordBatch.from_arrays([
            part.column("key"), pa.array(held, pa.bool_()), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
            pa.array([n_train] * len(bodies), pa.int64()), pa.array(base, pa.float64()), pa.array(scores),
            pa.array(-scores / np.log10(2) / (sizes + 1))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, fresh, count = None, [], {}
        gram, value = np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            places = batch.column("place").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(places[1:] != places[:-1]) + 1).tolist(), len(places)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                at, kind = divmod(int(places[lo]), 4)
                if at != block:
                    block, fresh, count = at, [], {}
                part = batch.slice(lo, hi - lo)
                if kind == GRAM:
                    fresh.append((part.column("key").to_numpy(zero_copy_only=False).view(np.uint64), part.column("value").to_numpy(zero_copy_only=False)))
                elif kind == WORD:
                    count.update(zip(part.column("body").to_pylist(), part.column("value").to_pylist(), strict=True))
                else:
                    if fresh:
                        gram, value = (np.concatenate(a) for a in zip(*fresh, strict=True))
                        order = np.argsort(gram)
                        gram, value, fresh = gram[order], value[order], []
                    yield scored(part, gram, value, count)

    return stream.repartition(F.shiftright("place", 2)).sortWithinPartitions("place").mapInArrow(run, SCORES)
