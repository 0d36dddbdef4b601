"""Kafka message -> bronze row: raw text kept verbatim, envelope metadata lifted out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import json_fns as J
from shelfcast.functions.ids import stable_ingest_id
from shelfcast.operators.repeated import keep_last_where_repeated, repeated_or_marked
from shelfcast.schemas import BRONZE


def _as_ts(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def decoded_text(binary: Column) -> Column:
    """Strict UTF-8 decode: bytes that are not valid UTF-8 abort the batch, nothing of it is landed."""
    text = binary.cast("string")
    bad = F.raise_error(F.concat(F.lit("message is not valid UTF-8 at "), F.concat_ws(":", "topic", "partition", "offset")))
    return F.when(text.isNull() | F.is_valid_utf8(text), text).otherwise(bad)


def event_ts_ms(v: Column) -> Column:
    """Envelope ``ts_ms``, else ``source.ts_ms``; a zero counts as missing."""
    return F.coalesce(F.nullif(J.path(v, "$.ts_ms", "bigint"), F.lit(0)), J.path(v, "$.source.ts_ms", "bigint"))


# The parsed envelope, where bronze rows carry it to the silver step of the same job.
ENVELOPE = "_v"


def bronze_rows(kafka: DataFrame, ingested_at: Column | str, with_envelope: bool = False) -> DataFrame:
    """Project Kafka-shaped rows (key, value, topic, partition, offset, ...) to the bronze schema.

    ``ingested_at`` is the landing instant (a parameter: results never read the wall clock).
    A null or unparseable value gives an empty envelope: every metadata column is NULL.
    ``with_envelope`` keeps the parsed envelope beside the schema's columns, for rows that go
    on to silver without being stored: parsing is the dearest step, so it is done once.
    """
    landed = _as_ts(ingested_at)
    staged = kafka.select(
        F.col("topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        decoded_text(F.col("key")).alias("kafka_key"),
        decoded_text(F.col("value")).alias("debezium_value"),
    ).withColumn(ENVELOPE, J.parse("debezium_value"))
    v = F.col(ENVELOPE)
    out = staged.select(
        stable_ingest_id(F.col("topic"), F.col("kafka_partition"), F.col("kafka_offset")).alias("ingest_id"),
        landed.alias("ingested_at"),
        F.to_date(landed).alias("ingest_date"),
        F.col("topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        J.path(v, "$.source.schema").alias("source_schema"),
        J.path(v, "$.source.table").alias("source_table"),
        J.path(v, "$.op").alias("operation"),
        event_ts_ms(v).alias("event_ts_ms"),
        J.path(v, "$.source.lsn", "bigint").alias("source_lsn"),
        F.col("kafka_key"),
        F.col("debezium_value"),
        v,
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE.fields], *([v] if with_envelope else []))


def dedup_landing(bronze: DataFrame) -> DataFrame:
    """One row per ``ingest_id`` (i.e. per Kafka coordinate), keeping the latest landing.

    Exactly-once-like landing over an at-least-once source.  Which ids repeat is found
    first, from their hashes, so rows that came once are not shuffled.  ``max_by``
    aggregates partially before the shuffle, so a hot id never gathers in one task.
    """
    return keep_last_where_repeated(bronze, ["ingest_id"], repeated_or_marked(bronze, ["ingest_id"]), last_per_id)


def last_per_id(bronze: DataFrame) -> DataFrame:
    others = [c for c in bronze.columns if c != "ingest_id"]
    winner = F.max_by(F.struct(*others), F.struct("ingested_at", "debezium_value"))
    return bronze.groupBy("ingest_id").agg(winner.alias("_w")).select(
        *[F.col("ingest_id") if c == "ingest_id" else F.col(f"_w.{c}").alias(c) for c in bronze.columns]
    )
