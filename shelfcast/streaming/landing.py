"""Structured Streaming landing of the change stream into bronze.

A bounded drain is ``trigger(availableNow=True)``: every message available at
start is processed in micro-batches, then the query stops.  With an idle timeout
the query polls instead and stops once nothing has arrived for that long.  Offsets (or
processed files) are committed to the checkpoint only after a batch is written,
so a restart resumes without loss.  The sink is idempotent on Kafka coordinates:
a batch is compared with the stored rows of its own offset ranges, so replays
and redeliveries add nothing and no full id column is read.
"""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.config import LandingSettings
from shelfcast.errors import BronzeLandingError
from shelfcast.operators import bronze as B
from shelfcast.plans.jobs import rows_to_land, write_bronze
from shelfcast.schemas import DEFAULT_TOPICS, KAFKA_ROW
from shelfcast.sources import lakehouse as L

COORDINATES = ["topic", "partition", "offset"]
RUN_MARKER = "overwrite_run"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def land_with_settings(spark: SparkSession, settings: LandingSettings, topics: list[str] | None = None,
                       options: dict[str, str] | None = None) -> dict:
    """S2 with the model's knobs: batch size, message cap, idle timeout, write mode."""
    return land_bronze_stream(spark, settings.source, settings.bronze_path, settings.checkpoint, settings.mode,
                              max_per_trigger=settings.batch_size if settings.source == "kafka" else None,
                              topics=topics, options=options, max_messages=settings.max_messages,
                              idle_timeout_seconds=settings.idle_timeout_seconds)


def read_change_stream(spark: SparkSession, source: str, topics: list[str] | None = None,
                       max_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """The change stream.  ``source`` is ``kafka`` (with ``kafka.bootstrap.servers``
    in ``options``; needs the Kafka connector jar; without ``topics`` the four retail
    topics) or a folder of Kafka-shaped files (without ``topics``: all of them)."""
    opts = dict(options or {})
    if source == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", ",".join(topics or DEFAULT_TOPICS))
        reader = reader.option("startingOffsets", "earliest")
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.options(**opts).load()
    reader = spark.readStream.schema(KAFKA_ROW).options(**opts)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    df = reader.parquet(source)
    return df.filter(F.col("topic").isin(topics)) if topics else df


def read_change_batch(spark: SparkSession, source: str, ranges: dict[str, dict[int, tuple[int, int]]],
                      options: dict[str, str] | None = None) -> DataFrame:
    """The messages of given offset ranges, {topic: {partition: (first, past the last)}}, as a batch.

    ``kafka`` reads just those offsets; in a folder of Kafka-shaped files the ranges are
    pushed into the scan.  Land the result with ``land_bronze_batch``.
    """
    if source == "kafka":
        start, end = ({t: {str(p): r[i] for p, r in parts.items()} for t, parts in ranges.items()} for i in (0, 1))
        reader = spark.read.format("kafka").option("subscribe", ",".join(ranges))
        return (reader.option("startingOffsets", json.dumps(start)).option("endingOffsets", json.dumps(end))
                .options(**(options or {})).load())
    wanted = [(F.col("topic") == t) & (F.col("partition") == p) & (F.col("offset") >= first) & (F.col("offset") < past)
              for t, parts in ranges.items() for p, (first, past) in parts.items()]
    return spark.read.schema(KAFKA_ROW).options(**(options or {})).parquet(source).where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started in here keep their state in RocksDB: bounded memory and a lookup per row, where the
    default holds every key on the heap and writes whole snapshots of them."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def dedup_within_watermark(stream: DataFrame, delay: str) -> DataFrame:
    """T3 as a streaming operator: drop redelivered messages (same coordinates) seen
    within ``delay`` of broker time.  Lossy: Spark discards every row older than the
    watermark, redelivered or not, so landing uses it only when asked to; the sink
    removes duplicates exactly either way."""
    return stream.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(COORDINATES)


def bronze_sink(path: str, mode: str = "append", checkpoint: str | None = None):
    """foreachBatch writer returning the rows it landed.

    ``overwrite`` replaces the table at the first batch of a run.  The run's first
    batch id is kept beside the checkpoint until the run ends, so a run that failed
    half-way goes on with the same first batch when it is started again.
    """
    marker = f"{checkpoint.rstrip('/')}/{RUN_MARKER}" if checkpoint and mode == "overwrite" else None

    def is_first(spark: SparkSession, batch_id: int) -> bool:
        if mode != "overwrite":
            return False
        known = L.read_small_file(spark, marker) if marker else None
        if known is None:
            known = str(batch_id)
            if marker:
                L.write_small_file(spark, marker, known)
        return int(known) == batch_id

    started: dict[str, int] = {}

    def write(batch: DataFrame, batch_id: int) -> int:
        spark = batch.sparkSession
        rows = B.bronze_rows(batch, F.current_timestamp())
        if marker or mode != "overwrite":
            first = is_first(spark, batch_id)
        else:
            first = started.setdefault("id", batch_id) == batch_id
        with rows_to_land(rows, None if first else path) as fresh:
            return write_bronze(fresh, path, "overwrite" if first else "append")

    def finish(spark: SparkSession) -> None:
        if marker:
            L.discard(spark, marker)

    write.finish = finish
    return write


def land_bronze_stream(spark: SparkSession, source: str, bronze_path: str, checkpoint: str,
                       mode: str = "append", max_per_trigger: int | None = None,
                       topics: list[str] | None = None, options: dict[str, str] | None = None,
                       watermark_delay: str | None = None, max_messages: int | None = None,
                       idle_timeout_seconds: float | None = None, poll_seconds: float = 1.0) -> dict:
    """Drain the stream into bronze and stop (availableNow).

    With ``max_messages`` the drain also stops once that many rows are committed
    (``stopped_at_cap`` in the summary); the next run resumes there.  With
    ``idle_timeout_seconds`` the source is polled every ``poll_seconds`` and the drain
    ends, between two batches, once that long has passed without a message
    (``stopped_idle``).  A batch that
    cannot be landed - undecodable bytes, a failing write - raises
    ``BronzeLandingError`` with its offsets uncommitted.
    """
    stream = read_change_stream(spark, source, topics, max_per_trigger, options)
    if watermark_delay:
        stream = dedup_within_watermark(stream, watermark_delay)
    landed = {"rows": 0, "full": False, "refused": False, "idle": False, "seen": time.monotonic()}
    sink = bronze_sink(bronze_path, mode, checkpoint)

    def bounded(batch: DataFrame, batch_id: int) -> None:
        # A batch that starts after the cap was reached must stay uncommitted (its
        # messages would be lost to the next run), so it is refused.
        if landed["full"]:
            landed["refused"] = True
            raise BronzeLandingError("cap reached before this batch")
        landed["rows"] += sink(batch, batch_id)
        landed["seen"] = time.monotonic()
        landed["full"] = max_messages is not None and landed["rows"] >= max_messages

    started_at = spark.sql("SELECT current_timestamp()").first()[0]
    query = (
        stream.writeStream.foreachBatch(bounded)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if idle_timeout_seconds is None else {"processingTime": f"{round(poll_seconds * 1000)} milliseconds"}))
        .start()
    )
    try:
        while query.isActive and not landed["full"] and not landed["idle"]:
            query.awaitTermination(0.2)
            quiet = idle_timeout_seconds is not None and time.monotonic() - landed["seen"] >= idle_timeout_seconds
            # never in the middle of a batch
            landed["idle"] = quiet and not query.status["isTriggerActive"]
        if query.isActive:
            query.stop()
        query.awaitTermination()
    except PySparkException as exc:
        if not landed["refused"]:
            raise BronzeLandingError(f"Landing into {bronze_path} failed: {exc}") from exc
    sink.finish(spark)
    progress = query.recentProgress
    return {
        "table_uri": bronze_path,
        "topics": list(topics or DEFAULT_TOPICS),
        "batches": len([p for p in progress if p.get("numInputRows", 0) > 0]),
        "input_rows": sum(p.get("numInputRows", 0) for p in progress),
        "landed_rows": landed["rows"],
        "stopped_at_cap": landed["full"],
        "stopped_idle": landed["idle"],
        "started_at": started_at,
        "finished_at": spark.sql("SELECT current_timestamp()").first()[0],
        "mode": mode,
    }
