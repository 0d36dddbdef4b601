"""T5: current transactions kept up to date by the change stream, one batch at a time.

The state is a table of the latest event per transaction, deletes included (a
tombstone must still beat an older event that arrives late).  It is cut into
buckets by the key's hash.  A micro-batch is reduced to one row per key and merged
with the stored rows of the buckets it touches; only those buckets are written,
under ``batch=<id>``.  A large bucket is not rewritten by every batch: the batch's rows
are put beside it (``bucket=<n>+``) until they are as large as the bucket, so all that is
written stays in proportion to what arrives; readers take the latest of both.  The batch is committed by the folder's ``_SUCCESS`` marker, so
readers never see half a batch; a batch that is run again overwrites its own folder.
"Latest" is a maximum over the event order, so redelivery, replay and any order of
arrival give the same state.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators import bronze as B
from shelfcast.operators import gold as G
from shelfcast.operators import silver as S
from shelfcast.schemas import CURRENT_TRANSACTION_COLUMNS
from shelfcast.sources import lakehouse as L
from shelfcast.streaming.landing import read_change_stream

KEY = "transaction_key"
CARRIED = [*G.EVENT_ORDER_COLUMNS, "is_deleted", "record_data"]
STATE_SCHEMA = (f"{KEY} string, event_at timestamp, source_lsn long, kafka_topic string, kafka_partition int, kafka_offset long, "
                "is_deleted boolean, record_data string")
BUCKETS = 64
# Buckets below this size are rewritten by every batch that touches them.
SMALL_BUCKET_BYTES = 1 << 20
ADDED = "+"


def bucket_of(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def committed_parts(spark: SparkSession, root: str, before: int | None = None) -> dict[str, str]:
    """partition value -> folder of its newest committed version (of batches below ``before``)."""
    found: dict[str, tuple[int, str]] = {}
    for batch, value, path in _written_parts(spark, root, before):
        if not value.endswith(ADDED) and found.get(value, (-1, ""))[0] < batch:
            found[value] = (batch, path)
    return {value: path for value, (_, path) in found.items()}


def _written_parts(spark: SparkSession, root: str, before: int | None = None) -> list[tuple[int, str, str]]:
    """(batch, partition value, folder) of every committed batch (below ``before``)."""
    out = []
    for name in L.list_folders(spark, root):
        batch = int(name.partition("=")[2])
        if (before is not None and batch >= before) or not L.table_exists(spark, f"{root}/{name}/_SUCCESS"):
            continue
        out += [(batch, unquote(part.partition("=")[2]), f"{root}/{name}/{part}") for part in L.list_folders(spark, f"{root}/{name}")]
    return out


def live_parts(spark: SparkSession, root: str, before: int | None = None) -> dict[str, list[str]]:
    """bucket -> its folders: the newest whole version, then the rows added to it since."""
    written, whole = _written_parts(spark, root, before), {}
    for batch, value, path in written:
        if not value.endswith(ADDED):
            whole[value] = max(whole.get(value, (-1, "")), (batch, path))
    found = {value: [path] for value, (_, path) in whole.items()}
    for batch, value, path in sorted(written):
        bucket = value.removesuffix(ADDED)
        if value.endswith(ADDED) and batch > whole.get(bucket, (-1, ""))[0]:
            found.setdefault(bucket, []).append(path)
    return found


def next_batch(spark: SparkSession, root: str) -> int:
    """One more than the newest batch folder, committed or not."""
    return max((int(name.partition("=")[2]) for name in L.list_folders(spark, root)), default=-1) + 1


def read_parts(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*sorted(paths)) if paths else spark.createDataFrame([], schema)


def latest_events(messages: DataFrame) -> DataFrame:
    """Kafka rows -> the latest sales event of every transaction among them."""
    # counted where they are parsed: the filter on the source table stops there and does not parse each message once more
    counted = (Observation(), [F.count(F.lit(1)).alias("envelopes")])
    bronze = B.bronze_rows(messages, F.current_timestamp(), with_envelope=True)
    silver = S.silver_rows(bronze, F.current_timestamp(), observe=counted)
    sales = G.sales_events(silver).withColumn(KEY, G.transaction_key())
    return G.latest_per_key(sales, KEY, CARRIED)


def merge_batch(messages: DataFrame, batch_id: int, root: str, buckets: int = BUCKETS) -> list[int]:
    """Merge one micro-batch of Kafka rows into the state; returns the buckets it wrote."""
    new = latest_events(messages).persist()
    try:
        return merge_events(new, batch_id, root, buckets)
    finally:
        new.unpersist()


def stored_events(spark: SparkSession, root: str, touched: list[int], before: int | None = None) -> DataFrame:
    stored = live_parts(spark, root, before)
    return _latest(spark, [stored[str(b)] for b in touched if str(b) in stored])


def _latest(spark: SparkSession, parts: list[list[str]]) -> DataFrame:
    """One row per key of these buckets; those without added rows are read as they are."""
    alone = read_parts(spark, [p for paths in parts if len(paths) == 1 for p in paths], STATE_SCHEMA)
    several = [p for paths in parts if len(paths) > 1 for p in paths]
    return alone.unionByName(G.latest_per_key(read_parts(spark, several, STATE_SCHEMA), KEY, CARRIED)) if several else alone


def touched_buckets(new: DataFrame, buckets: int = BUCKETS) -> list[int]:
    return sorted(r[0] for r in new.select(bucket_of(F.col(KEY), buckets).alias("b")).distinct().collect())


def merge_events(new: DataFrame, batch_id: int, root: str, buckets: int = BUCKETS) -> list[int]:
    """Merge the latest events of a batch, one per key, into the buckets of their keys."""
    spark, bucket = new.sparkSession, bucket_of(F.col(KEY), buckets)
    touched = touched_buckets(new, buckets)
    if touched:
        stored = live_parts(spark, root, before=batch_id)
        parts = {b: stored.get(str(b), []) for b in touched}
        added = [b for b, paths in parts.items() if paths and not _outgrown(spark, paths)]
        old = read_parts(spark, [p for b, paths in parts.items() if b not in added for p in paths], STATE_SCHEMA)
        new = new.select(*old.columns).withColumn("bucket", bucket)
        whole = old.withColumn("bucket", bucket).unionByName(new.where(~F.col("bucket").isin(added)))
        # dealt out by bucket once, for the merge and for the write
        merged = G.latest_per_key(whole.repartition("bucket"), ["bucket", KEY], CARRIED).withColumn("bucket", F.col("bucket").cast("string"))
        beside = new.where(F.col("bucket").isin(added)).withColumn("bucket", F.concat(F.col("bucket").cast("string"), F.lit(ADDED)))
        # a bucket's added rows are one file and not one of every task: files would grow with tasks times batches
        merged.unionByName(beside.hint("rebalance", "bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch={batch_id}")
    return touched


def _outgrown(spark: SparkSession, paths: list[str]) -> bool:
    """Whether a bucket is small, or the rows added to it have become as large as itself."""
    own, *added = (L.folder_bytes(spark, p) for p in paths)
    return own < SMALL_BUCKET_BYTES or sum(added) >= own


def drop_superseded(spark: SparkSession, root: str, keep_from: int) -> None:
    """Delete partition versions that a newer committed batch below ``keep_from`` replaces."""
    current = {p for paths in live_parts(spark, root, before=keep_from).values() for p in paths}
    for name in L.list_folders(spark, root):
        if int(name.partition("=")[2]) < keep_from:
            for part in L.list_folders(spark, f"{root}/{name}"):
                if f"{root}/{name}/{part}" not in current:
                    L.discard(spark, f"{root}/{name}/{part}")


def maintain_current_state(spark: SparkSession, source: str, root: str, checkpoint: str, buckets: int = BUCKETS,
                           max_per_trigger: int | None = None, options: dict[str, str] | None = None) -> dict:
    """Drain the change stream into the state table and stop; ``batches`` lists the buckets each batch wrote."""
    root = root.rstrip("/")
    written: dict[int, list[int]] = {}

    def merge(batch: DataFrame, batch_id: int) -> None:
        written[batch_id] = merge_batch(batch, batch_id, root, buckets)
        drop_superseded(spark, root, batch_id)  # the version before this batch stays for its readers

    query = (read_change_stream(spark, source, max_per_trigger=max_per_trigger, options=options).writeStream
             .foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return {"table_uri": root, "buckets": buckets, "batches": written}


def current_state(spark: SparkSession, root: str) -> DataFrame:
    """The latest event of every transaction, tombstones included."""
    return _latest(spark, list(live_parts(spark, root.rstrip("/")).values()))


def current_transactions(spark: SparkSession, root: str) -> DataFrame:
    """The live transactions of the state, typed."""
    live = current_state(spark, root).filter(~F.col("is_deleted"))
    return G.typed_sales(live).select(*CURRENT_TRANSACTION_COLUMNS)
