"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Terms (whole words and word beginnings) are counted by Spark in the toxic and
   the clean texts of a labelled sample; the likeliest toxic ones are kept.
2. Voters look at a text and vote toxic (1), clean (-1) or abstain (0): a fixed
   lexicon of insults, patterns (insult aimed at someone, several insults),
   lexicons mined from the terms, dealt over several voters, density of found
   words, and two voters for clean: a single stray term, and nothing found.
3. The label model sees only votes.  Spark counts vote patterns over all
   documents; expectation-maximisation of a two-class model estimates each
   voter's vote distribution per class, hence its accuracy.  Voters whose votes
   correlate within a class (pairwise moments) share their weight.
4. Posterior labels of the sample's rows, averaged with the known label, train
   a logistic regression over terms and votes.
5. Every whole text is scored by the linear model in one scan.

``sample_rows`` and ``terms`` are documented bounds on what the model is fitted
on and how large it is; the vote counts cover all documents, and no text is cut.

Edge cases: null and empty texts have no terms and get the score of the
intercept; rows without a label are scored only; null ids have no label and are
never held out; labels missing or of one class leave the fixed lexicon and
patterns; several labels of an id count as their maximum; repeated rows score
alike; other input columns are ignored or carried unchanged.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import common as C

THRESHOLD = 0.3
SAMPLE_ROWS = 20_000
TERMS = 4096
STEMS = (4, 5, 6)
MINED_VOTERS = 4

# fixed values: insults of the base lexicon
INSULTS = "clown disgusting dumb fool idiot imbecile jerk loser moron pathetic scum stupid trash useless worthless".split()

_WORD = re.compile(r"[^\W_]+")
_AIMED = re.compile(r"\b(?:you|your|he|she|they|is|are|such)\s+(?:\w+\s+){0,2}?(?:" + "|".join(INSULTS) + r")s?\b")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def terms_of(words: set[str]) -> Iterator[str]:
    """Whole words, and beginnings marked by their length (``lost*``)."""
    yield from words
    for n in STEMS:
        for stem in {w[:n] for w in words if len(w) > n}:
            yield stem + "*"


class Voters:
    """The vote functions and the term table of the classifier."""

    names = ("insults", "aimed", "several", *(f"mined{i}" for i in range(MINED_VOTERS)), "dense", "stray", "quiet")
    #: Found words in all, and per 1000 words, at which a further column of the classifier is set.
    steps, rates = (2, 3, 5, 10), (2, 5, 10, 20)

    def __init__(self, terms: list[str]):
        self.terms = list(terms)
        self.whole = {t: i for i, t in enumerate(terms) if not t.endswith("*")}
        self.stems = {n: {t[:-1]: i for i, t in enumerate(terms) if t.endswith("*") and len(t) == n + 1} for n in STEMS}
        self.fixed = frozenset(INSULTS)

    def look(self, text: str | None) -> tuple[list[int], list[int]]:
        """(votes, classifier columns) of one text; the columns are term numbers, then amounts."""
        words = words_of(text)
        seen = set(words)
        found = [self.whole[w] for w in self.whole.keys() & seen]
        for n, table in self.stems.items():
            if table:
                found += [table[s] for s in table.keys() & {w[:n] for w in seen if len(w) > n}]
        insults = sum(w in self.fixed for w in words) if self.fixed & seen else 0
        hits = insults
        if found:
            known = {w for w in seen if w in self.whole or w in self.fixed or any(len(w) > n and w[:n] in table for n, table in self.stems.items())}
            hits = sum(w in known for w in words)
        rate = 1000 * hits / max(1, len(words))
        mined = {i % MINED_VOTERS for i in found}
        aimed = insults > 0 and _AIMED.search(text.lower()) is not None
        votes = [int(insults > 0), int(aimed), int(insults > 1), *[int(i in mined) for i in range(MINED_VOTERS)],
                 int(hits > 2 and rate > 4), -int(hits == 1 and not insults), -int(bool(words) and not hits)]
        amounts = [hits >= n for n in self.steps] + [hits > 0 and rate >= r for r in self.rates]
        return votes, sorted(found) + [len(self.terms) + i for i, on in enumerate(amounts) if on]


class LabelModel:
    """Two-class generative model of vote patterns, fitted by expectation-maximisation on their counts."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 40):
        x = self._shape(patterns)
        counts = counts.astype(float)
        self.prior, self.weight = min(max(prior, 1e-3), 0.5), np.ones(patterns.shape[1])
        post = np.where(patterns.sum(axis=1) > 0, 0.9, 0.02)
        for i in range(rounds):
            mass = np.stack([counts * (1 - post), counts * post])
            self.table = (np.einsum("cp,pvk->cvk", mass, x) + 0.1) / (mass.sum(axis=1)[:, None, None] + 0.3)
            if i == rounds // 2:
                self.weight = self._shared(patterns, mass)
            post = self._posterior(x)

    @staticmethod
    def _shape(patterns: np.ndarray) -> np.ndarray:
        return np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)

    @staticmethod
    def _shared(patterns: np.ndarray, masses: np.ndarray) -> np.ndarray:
        """Weight 1 / (1 + the voter's summed within-class correlations above 0.2)."""
        most = np.zeros((patterns.shape[1],) * 2)
        for mass in masses:
            if mass.sum() >= 1:
                d = patterns - mass @ patterns / mass.sum()
                cov = (d * mass[:, None]).T @ d / mass.sum()
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                most = np.maximum(most, np.abs(cov / sd[:, None] / sd[None, :]))
        np.fill_diagonal(most, 0)
        return 1 / (1 + np.where(most > 0.2, most, 0).sum(axis=1))

    def _posterior(self, x: np.ndarray) -> np.ndarray:
        logs = np.einsum("pvk,cvk,v->cp", x, np.log(self.table), self.weight) + np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return self._posterior(self._shape(patterns))

    def accuracies(self) -> dict[str, float]:
        """P(class | the voter spoke), by its own vote's sign."""
        joint = self.table * np.array([1 - self.prior, self.prior])[:, None, None]
        right, wrong = joint[1, :, 2] + joint[0, :, 0], joint[0, :, 2] + joint[1, :, 0]
        return dict(zip(Voters.names, (right / (right + wrong)).tolist(), strict=True))


class Linear:
    """Logistic regression over term and vote presence, AdaGrad steps."""

    def __init__(self, n_terms: int):
        self.n_found = n_terms + len(Voters.steps) + len(Voters.rates)
        self.w, self.b = np.zeros(self.n_found + 2 * len(Voters.names)), 0.0

    def columns(self, votes: list[int], found: list[int]) -> list[int]:
        return found + [self.n_found + 2 * i + (v < 0) for i, v in enumerate(votes) if v]

    def fit(self, rows: list[list[int]], target: np.ndarray, epochs: int = 20, rate: float = 0.3, l2: float = 1e-5, batch: int = 128) -> Linear:
        rng = np.random.default_rng(11)
        seen, seen_b = np.full(len(self.w), 1e-8), 1e-8
        cols = [np.array(r, dtype=np.int64) for r in rows]
        for _ in range(epochs if rows else 0):
            for part in np.array_split(rng.permutation(len(rows)), -(-len(rows) // batch)):
                flat = np.concatenate([cols[i] for i in part])
                owner = np.repeat(np.arange(len(part)), [len(cols[i]) for i in part])
                z = np.bincount(owner, weights=self.w[flat], minlength=len(part)) + self.b
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[part]) / len(part)
                g = np.bincount(flat, weights=err[owner], minlength=len(self.w)) + l2 * self.w
                seen += g * g
                self.w -= rate * g / np.sqrt(seen)
                seen_b += err.sum() ** 2
                self.b -= rate * err.sum() / np.sqrt(seen_b)
        return self

    def score(self, votes: list[int], found: list[int]) -> float:
        z = float(self.w[self.columns(votes, found)].sum()) + self.b
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def fold(id_col: str):
    """crc32 of the id as text, modulo 4; fold 2 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, limit: int) -> DataFrame:
    """At most ``limit`` (t, label) rows that may be learned from, picked by id hash; only that bounded id list is broadcast."""
    own = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 2))
           .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
           .orderBy(F.xxhash64("_id"), "_id").limit(limit))
    return (docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("t"))
            .join(F.broadcast(own), F.col("_own") == F.col("_id")).select("t", F.col("_label").alias("label")))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts per term and label within a task."""
    counts = (Counter(), Counter())

    def flush():
        terms = list(counts[0].keys() | counts[1].keys())
        out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *[pa.array([c[t] for t in terms], pa.int64()) for c in counts]],
                                         names=["term", "clean", "toxic"])
        for c in counts:
            c.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label > 0].update(terms_of(set(words_of(text))))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield flush()
    yield flush()


def mine_terms(counted: DataFrame, n1: int, n0: int, limit: int, allowed: float = 5.0) -> list[str]:
    """The terms too frequent in toxic texts for chance: Chernoff bound of the binomial tail under ``allowed`` / number of terms."""
    p = n1 / (n0 + n1)
    frequent = C.persisted(counted.where(F.col("toxic") + F.col("clean") >= 3), "toxicity-terms")
    n = F.col("toxic") + F.col("clean")
    q = F.col("toxic") / n
    rest = F.when(q < 1, (1 - q) * F.log((1 - q) / F.lit(1 - p))).otherwise(F.lit(0.0))
    gain = n * (q * F.log(q / F.lit(p)) + rest)
    need = float(np.log(max(frequent.count(), 1) / allowed))
    strong = frequent.where((F.col("toxic") > 0) & (q > max(0.5, 2 * p))).withColumn("gain", gain).where(F.col("gain") >= need)
    return [r["term"] for r in strong.orderBy(F.desc("gain"), "term").limit(limit).collect()]


class Model:
    """What a scoring task needs: voters, classifier (and the label model for inspection)."""

    def __init__(self, voters: Voters, label_model: LabelModel, linear: Linear):
        self.voters, self.label_model, self.linear = voters, label_model, linear

    def score(self, text: str | None) -> float:
        return self.linear.score(*self.voters.look(text))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, terms: int = TERMS) -> Model:
    """Fit the model; counts over documents stay in Spark, at most ``sample_rows`` rows of term numbers reach the driver."""
    spark = docs.sparkSession
    sample = C.persisted(labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows), "toxicity-sample")
    sizes = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    n1, n0 = sizes["toxic"], sizes["n"] - sizes["toxic"]
    mined = []
    if n1 and n0:
        counted = sample.mapInArrow(_term_counts, "term string, clean long, toxic long").groupBy("term").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        mined = mine_terms(counted, n1, n0, terms)
    voters = Voters(mined)
    shared = spark.sparkContext.broadcast(voters)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            seen.update(tuple(shared.value.look(t)[0]) for t in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())],
                                         names=["votes", "n"])

    counted = docs.select(text_col).mapInArrow(patterns, "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    table = np.array([r["votes"] for r in counted], dtype=np.int64).reshape(-1, len(Voters.names))
    label_model = LabelModel(table, np.array([r["n"] for r in counted]), (n1 / (n0 + n1)) if n0 + n1 else 0.1)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [shared.value.look(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in seen], pa.list_(pa.int32())), pa.array([s[1] for s in seen], pa.list_(pa.int32())),
                                              batch.column(1)], names=["votes", "found", "label"])

    rows = sample.mapInArrow(look, "votes array<int>, found array<int>, label int").collect()
    linear = Linear(len(mined))
    if rows:
        votes = np.array([r["votes"] for r in rows], dtype=np.int64)
        target = 0.5 * label_model.posterior(votes) + 0.5 * np.array([min(1, max(0, r["label"])) for r in rows])
        linear.fit([linear.columns(r["votes"], r["found"]) for r in rows], target)
    return Model(voters, label_model, linear)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a double column ``name``: how likely the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = C.with_fields(docs, [T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield C.append_columns(batch, schema, {name: [shared.value.score(t) for t in texts]})

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """Rows of ``docs`` scored under ``threshold``, columns unchanged."""
    model = train(docs, labels, text_col=text_col, **options)
    marked = score(docs.select(F.struct(*docs.columns).alias("_own"), F.col(text_col).alias("_text")), model, "_text", "_score")
    return marked.where(F.col("_score") < threshold).select("_own.*")
