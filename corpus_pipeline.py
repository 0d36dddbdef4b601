"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, packing.

``STAGES`` lists (name, function) in order.  Each function takes (spark, docs,
sf_dir), works on all rows its predecessor kept and returns a DataFrame that is
written as Parquet and reread as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm import decontaminate, packing, repeats, simhash, toxicity


def toxic_rejects(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the model learns from the labelled rows among ``docs``."""
    C.prepare(spark)
    return toxicity.drop_toxic(docs, C.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest id) of every SimHash component stays."""
    C.prepare(spark)
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 200-byte string that starts anywhere else are cut from the texts; ``n_chars`` follows."""
    C.prepare(spark)
    return repeats.remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    C.prepare(spark)
    return decontaminate.drop_contaminated(docs, C.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document cut and packed into sequences of at most 1024 ids."""
    C.prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_rejects),
    ("simhash-near-dedup", near_duplicates),
    ("suffix-array-dedup", repeated_passages),
    ("benchmark-decontamination", decontamination),
    ("packing", pack_sequences),
]

# fitting, suffix ranks and tokenisation have no SQL form; a test compares run() with stages 2 to 5 in plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = C.table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = C.persisted(docs, f"pipeline-{name}")
    return docs
