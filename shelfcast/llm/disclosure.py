"""Personal data by pattern, and the terms that reveal it by corpus co-occurrence.

Base spans are found by fixed patterns (leftmost, not overlapping within a kind;
a match that fails its check is dropped and not retried):

* email, ip (parts up to 255), card (13 to 19 digits, Luhn), phone (9 to 15 digits)

Information-theoretic sanitisation protects the values found (entities).  With N
documents and df the number of documents that hold something:

* IC(entity) = log2(N / df(entity)), what knowing the entity tells
* PMI(entity, term) = log2(N * df(entity, term) / (df(entity) * df(term))), what the term
  tells about it; a term co-occurs where it stands within ``WINDOW`` words of the entity
* a term discloses an entity when PMI >= ``DISCLOSURE`` * IC and the two co-occur in two
  different surroundings at least (copies of one passage are one piece of evidence)

A disclosing term is a span of kind ``term`` wherever it stands.  Sanitised text
generalises it to its leading letters (``stem*``, the longest of ``STEMS``) when that
class, counted like a term, does not disclose an entity, and removes it otherwise.
Terms are runs of at least ``MIN_LETTERS`` letters outside base spans, without case.

All counts cover all documents.  Words are counted in two steps: first the pairs near
entities, then documents per candidate term.  A fixed-size hash filter spares the rows that
cannot be asked for; the exact joins after it decide, whatever the filter lets through.

Defined results: a null text is empty and has no spans; repeated rows and ids count as documents
of their own; rows come back as often as they stand in the table; an empty table gives an
empty result; columns of the same name as the new ones give way.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C

KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
WINDOW = 12
DISCLOSURE = 0.8
MIN_LETTERS = 3
STEMS = (5, 3)
# slots of the hash filter: 2 MB whatever the corpus
FILTER_BITS = 24
# items that a task counts before it hands the sums on
HELD_ITEMS = 200_000
# rows of a common term are spread over so many tasks
SALTS = 16

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email pattern, found from each @ so that long runs of letters are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        tail = _DOMAIN.match(text, at)
        if tail and at > done:
            head = _LOCAL.match(text[done:at][::-1])
            if head:
                yield at - head.end(), tail.end()
                done = tail.end()
                at = text.find("@", done)
                continue
        done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then by start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if not _DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub(r"[\x20-]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


def entity(kind: str, value: str) -> str:
    """One name per protected value: addresses without case, numbers by their digits."""
    return f"{kind}:{value.lower() if kind == 'email' else value if kind == 'ip' else re.sub(r'[^0-9]', '', value)}"


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with base spans blanked, offsets unchanged."""
    if not spans:
        return text
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if b > at:
            a = max(a, at)
            out += [text[at:a], " " * (b - a)]
            at = b
    return "".join([*out, text[at:]])


def stem(word: str, size: int) -> str | None:
    return word[:size] + "*" if len(word) > size else None


def items(word: str) -> list[str]:
    """A word as a term, and the classes it may be generalised to."""
    return [word, *[s for size in STEMS if (s := stem(word, size))]]


def surroundings(text: str, spans: list[tuple[str, int, int]]) -> dict[tuple[str, str], tuple[int, int]]:
    """(entity, item) -> least and greatest hash of the surroundings in which they co-occur, for one document."""
    out: dict[tuple[str, str], tuple[int, int]] = {}
    if not spans:
        return out
    words = [(m.start(), m[0].lower()) for m in _WORD.finditer(masked(text, spans)) if len(m[0]) >= MIN_LETTERS]
    starts = [s for s, _ in words]
    for kind, a, b in spans:
        lo, hi = bisect_left(starts, a), bisect_left(starts, b)
        near = [w for _, w in words[max(0, lo - WINDOW):hi + WINDOW]]
        name, place = entity(kind, text[a:b]), crc32(" ".join(near).encode())
        for item in {i for w in set(near) for i in items(w)}:
            old = out.get((name, item))
            out[name, item] = (min(place, old[0]), max(place, old[1])) if old else (place, place)
    return out


# ---------------------------------------------------------------- passes over the texts


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        yield batch, [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]


def _pairs(docs: DataFrame) -> DataFrame:
    """(entity, item, n, low, high): documents per pair, summed per task, and the bounds of their surroundings' hashes.
    An empty item counts the documents of the entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches):
            seen: dict[tuple[str, str], list[int]] = {}
            for text in texts:
                spans = base_spans(text)
                found = surroundings(text, spans)
                found |= {(entity(k, text[a:b]), ""): (0, 0) for k, a, b in spans}
                for pair, (low, high) in found.items():
                    old = seen.get(pair)
                    seen[pair] = [old[0] + 1, min(old[1], low), max(old[2], high)] if old else [1, low, high]
            rows = [(e, i, *v) for (e, i), v in seen.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], type=t) for c, t in enumerate([pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()])],
                names=["entity", "item", "n", "low", "high"])

    return docs.select("text").mapInArrow(run, "entity string, item string, n long, low long, high long")


def filter_of(df: DataFrame, column: str) -> np.ndarray:
    """Bits at the hashes of a column's values: a fixed ``2 ** FILTER_BITS`` bits, or-ed together in Spark."""
    slots = 1 << FILTER_BITS
    words = (df.select((F.crc32(F.col(column).cast("binary")) % slots).alias("h"))
             .groupBy(F.floor(F.col("h") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h % 64 as int))")).alias("bits")))
    rows = words.toPandas()
    table = np.zeros(slots // 64, dtype=np.int64)
    table[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)


def _maybe(table: np.ndarray, words: list[str]) -> list[str]:
    if not words:
        return []
    at = np.fromiter([crc32(w.encode()) for w in words], dtype=np.int64, count=len(words)) & ((1 << FILTER_BITS) - 1)
    hit = table[at]
    return [words[i] for i in np.flatnonzero(hit).tolist()]


def _vocabulary(text: str, spans: list[tuple[str, int, int]]) -> set[str]:
    return {w.lower() for w in set(_WORD.findall(masked(text, spans))) if len(w) >= MIN_LETTERS}


def _document_counts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(item, df): documents that hold each wanted term or class."""
    table = docs.sparkSession.sparkContext.broadcast(np.packbits(filter_of(wanted, "item")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(table.value).view(bool)
        seen: Counter[str] = Counter()

        def summed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([*seen], pa.string()), pa.array([*seen.values()], pa.int64())], names=["item", "n"])

        for _, texts in _texts(batches):
            for text in texts:
                words = _vocabulary(text, base_spans(text))
                seen.update(_maybe(bits, [*words, *{s for size in STEMS for w in words if (s := stem(w, size))}]))
            if len(seen) > HELD_ITEMS:
                yield summed()
                seen.clear()
        yield summed()

    counts = docs.select("text").mapInArrow(run, "item string, n long").groupBy("item").agg(F.sum("n").alias("df"))
    return wanted.select("item").distinct().join(counts, "item")


def _salt(column: str):
    return F.pmod(F.crc32(F.col(column).cast("binary")), F.lit(SALTS)).cast("int")


def disclosing(docs: DataFrame) -> DataFrame:
    """(term, general): the terms that disclose an entity and what each is generalised to (null: nothing general enough)."""
    counts = C.persisted(_pairs(docs).groupBy("entity", "item").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")), "pairs")
    total = docs.count()
    entities = counts.where("item = ''").select("entity", F.col("n").alias("df_entity"))
    pairs = counts.where("item <> '' AND low < high").select("entity", "item", "n")
    df = C.persisted(_document_counts(docs, pairs), "item-df")
    # a common word stands near very many entities: its pairs are dealt to SALTS tasks, its count is there once for each
    salted = df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pairs.withColumn("_salt", _salt("entity"))
    judged = dealt.join(salted, ["item", "_salt"]).join(entities, "entity").select(
        "item", (F.log2(F.lit(float(total)) * F.col("n") / (F.col("df_entity") * F.col("df"))) + 1e-9
                 >= DISCLOSURE * F.log2(F.lit(float(total)) / F.col("df_entity"))).alias("tells"))
    loud = C.persisted(judged.where("tells").select("item").distinct(), "disclosing")
    terms = loud.where("NOT endswith(item, '*')").select(F.col("item").alias("term"))
    classes = terms.select("term", F.posexplode(F.array(*[
        F.when(F.char_length("term") > size, F.concat(F.substring("term", 1, size), F.lit("*"))) for size in STEMS])).alias("rank", "item"))
    quiet = classes.where("item IS NOT NULL").join(loud, "item", "left_anti").groupBy("term").agg(F.min_by("item", "rank").alias("general"))
    return terms.join(quiet, "term", "left")


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                     T.StructField("general", T.StringType())])


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, _sha, copies, spans): one row per different (doc_id, text); spans by kind as listed, then start.

    ``copies`` says how often the row stands in the table."""
    terms = C.persisted(disclosing(docs), "terms")
    table = docs.sparkSession.sparkContext.broadcast(np.packbits(filter_of(terms, "term")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(table.value).view(bool)
        for batch, texts in _texts(batches):
            base, row, word, places = [], [], [], []
            for i, text in enumerate(texts):
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                words = set(_maybe(bits, [*_vocabulary(text, spans)]))
                if not words:
                    continue
                at = defaultdict(list)
                for m in _WORD.finditer(masked(text, spans)):
                    w = m[0].lower()
                    if w in words and len(m[0]) >= MIN_LETTERS:
                        at[w].append({"start": m.start(), "end": m.end()})
                for w, found in at.items():
                    row.append(i)
                    word.append(w)
                    places.append(found)
            place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            keys = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "_sha")]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(base, span), pa.nulls(len(texts), pa.string()), pa.nulls(len(texts), place)],
                names=["doc_id", "_sha", "base", "term", "places"])
            if row:
                yield pa.RecordBatch.from_arrays(
                    [*[k.take(pa.array(row)) for k in keys], pa.nulls(len(row), span), pa.array(word, pa.string()), pa.array(places, place)],
                    names=["doc_id", "_sha", "base", "term", "places"])

    out = ("doc_id long, _sha string, base array<struct<kind: string, start: long, end: long>>, term string, "
           "places array<struct<start: long, end: long>>")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("_sha"), "text")
    found = C.persisted(slim.mapInArrow(run, out), "spans")
    key = ["doc_id", "_sha"]
    rows = found.where("term IS NULL").groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.first("base").alias("_base"))
    # hits of a common term are dealt to SALTS tasks, its row is there once for each
    salted = terms.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = found.where("term IS NOT NULL").withColumn("_salt", _salt("_sha"))
    # equal rows have equal hits: distinct before they meet
    kept = hits.join(salted, ["term", "_salt"]).groupBy(*key, "term").agg(F.first("places").alias("places"), F.first("general").alias("general"))
    extra = kept.groupBy(*key).agg(F.sort_array(F.flatten(F.collect_list(F.transform("places", lambda p: F.struct(
        p["start"].alias("start"), p["end"].alias("end"), F.col("general").alias("general")))))).alias("_terms"))
    # null ids must meet their rows again
    joined = rows.join(extra.withColumnRenamed("doc_id", "_id").withColumnRenamed("_sha", "_sha2"),
                       (F.col("_sha") == F.col("_sha2")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    spans = F.concat(
        F.transform("_base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                F.lit(None).cast("string").alias("general"))),
        F.coalesce(F.transform("_terms", lambda s: F.struct(F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                            s["general"].alias("general"))), F.array().cast(T.ArrayType(SPAN))))
    return joined.select("doc_id", "_sha", "copies", spans.alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans`` and, in ``text``, ``[KIND]`` for base spans, the class for generalised terms and nothing for removed ones."""
    found = find_spans(docs).select("doc_id", "_sha", "spans").alias("found")
    rest = docs.drop("spans")
    sha = F.sha2(F.coalesce(F.col("here.text"), F.lit("")), 256)
    joined = rest.alias("here").join(found, (sha == F.col("found._sha")) & F.col("here.doc_id").cast("long").eqNullSafe(F.col("found.doc_id")))
    joined = joined.select("here.*", F.col("found.spans").alias("spans"))

    @F.udf("string", useArrow=True)
    def rewritten(text, spans):
        if text is None:
            return None
        out, at = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                word = s["general"] or "" if s["kind"] == TERM else f"[{s['kind'].upper()}]"
                out += [text[at:s["start"]], word]
                at = s["end"]
        return "".join([*out, text[at:]])

    return joined.withColumn("text", rewritten("text", "spans"))


def joined_spans(spans):
    """Column: ``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, base spans by kind, their digest, all spans, and how many terms disclose an entity."""
    found = find_spans(docs)
    base = F.filter("spans", lambda s: s["kind"] != TERM)

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    row = F.struct("doc_id", *[number(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined_spans(base), 256).alias("base_sha256"),
                   joined_spans(F.col("spans")).alias("spans"), number(TERM).alias("n_term"))
    # a row that is there very often comes back in two steps, neither of which holds a long array
    some = 4096
    blocks = found.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"cast((copies - 1) div {some} as int)"))))
    n = F.least(F.lit(some).cast("long"), F.col("copies") - F.col("_block") * some).cast("int")
    return blocks.select(F.explode(F.array_repeat(row, n)).alias("r")).select("r.*")
