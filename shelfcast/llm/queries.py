"""Thin registered queries: each runs its operator over a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import aligntokens, bitplanes, ctw, decontaminate, disclosure, filteraudit, multiset, packing, pagediff, repeats, simhash, toxicity, warc
from shelfcast.llm import common as C
from shelfcast.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        C.prepare(spark)
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, C.table(spark, sf_dir, "benchmark"))
    n_hit = decontaminate.hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, read back, deduplicated by payload digest into new archives, and read again."""
    pages = C.table(spark, sf_dir, "pages")
    raw, slim = scratch_path(spark, "llm", "warc-raw"), scratch_path(spark, "llm", "warc-dedup")
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    warc.write_archives(warc.page_records(pages), raw, mean)
    warc.dedup_archives(spark, raw, slim)
    records = warc.read_archives(spark, slim, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut and packed into sequences of at most 1024 ids."""
    return packing.pack(C.table(spark, sf_dir, "documents"))


@query
def op7_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as bit planes and checked from the files."""
    target = scratch_path(spark, "llm", "bitplanes")
    bitplanes.write_ids(C.table(spark, sf_dir, "documents"), target)
    return bitplanes.document_checksums(spark, target)


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents at 4 differing bits."""
    found = simhash.near_duplicates(C.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every document and its edited text."""
    return multiset.edited_fingerprints(C.table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 200-byte string that starts anywhere else."""
    return repeats.removal_report(C.table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model learned outside fold 2."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, C.table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(toxicity.fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree weighting scores of every document, learned outside the held-out fold."""
    return ctw.score(C.table(spark, sf_dir, "documents"))


@query
def op9_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by differencing with its nearest page."""
    found = pagediff.extract(C.table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars", "n_shared", "n_markup")


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders: what each step keeps, removes and repeats, per language."""
    return filteraudit.interaction_audit(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))


@query
def op11_token_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenizers per document, judged by corpus-wide link counts."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return aligntokens.corpus_alignment(docs).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms that reveal it."""
    return disclosure.span_report(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
