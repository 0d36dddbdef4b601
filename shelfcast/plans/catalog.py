"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the given tables (or data Spark derives from them) in full.
Outputs are made comparable across engines at the edge only: timestamps are
shown as UTC wall-clock (TIMESTAMP_NTZ) and decimals as doubles; wall-clock
columns such as load instants are left out.  Queries that write tables
(landing, end-to-end, table loads) write under the shared checkpoint folder.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.operators import bronze as B
from shelfcast.operators import constraints as C
from shelfcast.operators import drivers as D
from shelfcast.operators import forecast as FC
from shelfcast.operators import gold as G
from shelfcast.operators import history as H
from shelfcast.operators import planning as P
from shelfcast.operators import quality as Q
from shelfcast.operators import silver as S
from shelfcast.plans import jobs as JOBS
from shelfcast.plans import metadata as META
from shelfcast.schemas import BRONZE, KAFKA_ROW, SALES_TRANSACTIONS
from shelfcast.session import apply_required_conf, scratch_path
from shelfcast.sources import lakehouse as L
from shelfcast.sources import retail_view as RV
from shelfcast.streaming import current_state as STATE
from shelfcast.streaming import daily_demand as DAILY
from shelfcast.streaming import landing as STREAM

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# The second landing of redelivered messages happens one day after the first.
REDELIVERY_LANDED_AT = "2026-01-02 06:00:00"
PINBALL_QUANTILES = [0.1, 0.5, 0.9]


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run

    return register


def comparable(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Engine-neutral output types: TIMESTAMP -> UTC wall clock, DECIMAL -> DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ shared chains


def landed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log -> bronze rows, as one batch landing writes them."""
    return B.bronze_rows(RV.change_log(spark, sf_dir), RV.AS_OF)


def landed_bronze_with_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two landings: the whole log, then the redelivered messages a day later."""
    first = B.bronze_rows(RV.change_log(spark, sf_dir), RV.AS_OF)
    again = B.bronze_rows(RV.redelivered_messages(spark, sf_dir), REDELIVERY_LANDED_AT)
    return first.unionByName(again)


def bronze_for_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed bronze that goes on to silver in the same job: envelopes stay parsed, rows stay spread over all tasks."""
    return B.bronze_rows(RV.change_log(spark, sf_dir, spread=True), RV.AS_OF, with_envelope=True)


def twice_landed_for_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``landed_bronze_with_redelivery`` that goes on to silver in the same job."""
    again = B.bronze_rows(RV.redelivered_messages(spark, sf_dir, spread=True), REDELIVERY_LANDED_AT, with_envelope=True)
    return bronze_for_silver(spark, sf_dir).unionByName(again)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.silver_events(bronze_for_silver(spark, sf_dir), RV.AS_OF)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver for queries that read it several times: rows are stored as they are made, and the last copy of each
    coordinate is kept from there, so the messages behind them are made once.  Left out is what follows from the rest."""
    rows = S.silver_rows(bronze_for_silver(spark, sf_dir), RV.AS_OF)
    return S.last_events(stored(rows.drop("event_id", "operation_name", "event_date", "silver_loaded_at")))


def filtered_silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver for queries that filter it: the envelopes are counted where they are parsed, so a
    filter on silver columns stops there and does not build and parse each message once more."""
    counted = (Observation(), [F.count(F.lit(1)).alias("envelopes")])
    return S.silver_events(bronze_for_silver(spark, sf_dir), RV.AS_OF, observe=counted)


def gold_from_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from typed change events (same rules, no JSON): the input of forecasting."""
    return G.gold_daily_demand(current_typed(spark, sf_dir), RV.AS_OF)


def current_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.current_from_typed_events(RV.sales_change_events(spark, sf_dir))


def stored(df: DataFrame) -> DataFrame:
    """Stand-in for a stored table: written once under the shared checkpoint folder (compressed,
    by column), so queries that aggregate it several ways read their columns and do not re-derive it."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def retail_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four retail tables in their current state."""
    sales_cols = [f.name for f in SALES_TRANSACTIONS.fields]
    return {
        "stores": RV.stores(spark, sf_dir),
        "products": RV.products(spark, sf_dir),
        "promotions": stored(RV.promotions(spark, sf_dir)),
        "sales_transactions": stored(current_typed(spark, sf_dir).select(*sales_cols)),
    }


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold materialised once under the shared checkpoint folder.

    Forecast and driver queries read gold several times (calendar bounds, the
    holdout window, the panel itself), exactly as they would read the stored gold
    table; checkpointing cuts the lineage so none of those re-derives gold."""
    return stored(gold_from_typed(spark, sf_dir))


def panel_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    """Panel over checkpointed gold, with its calendar bounds (two dates)."""
    gold = gold_table(spark, sf_dir)
    bounds = FC.calendar_bounds(gold)
    return FC.demand_panel(gold, bounds), bounds


def window_scalars(bounds: tuple, holdout: int = FC.HOLDOUT_DAYS):
    """test_start / test_end of the holdout: the panel's last day and holdout-1 before."""
    hi = bounds[1]
    return hi - timedelta(days=holdout - 1), hi


# --------------------------------------------------------- bronze / landing


@query("bronze_rows")
def q_bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka messages of all four tables -> bronze rows."""
    return comparable(landed_bronze(spark, sf_dir),
                      drop=("ingested_at", "ingest_date", "debezium_value"))


@query("ingest_ids")
def q_ingest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sha256 ids per message; a redelivered message gets the same id."""
    log = RV.change_log(spark, sf_dir, redeliver=True)
    return log.select(
        "topic", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        F.sha2(F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")),
               256).alias("ingest_id"),
    )


def _stream_source(spark: SparkSession, sf_dir: str, redeliver: bool) -> str:
    """Write the change log as files, the shape a file-backed stream reads."""
    src = scratch_path(spark, "stream_source")
    RV.change_log(spark, sf_dir, redeliver=redeliver).write.option("compression", "zstd").parquet(src)
    return src


@query("land_bronze_stream")
def q_land_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """availableNow drain, a few files per micro-batch, the run's first batch overwrites."""
    src = _stream_source(spark, sf_dir, redeliver=False)
    bronze = scratch_path(spark, "bronze_stream")
    STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "stream_ckpt"), mode="overwrite", max_per_trigger=8)
    return comparable(L.read_lake_table(spark, bronze),
                      drop=("ingested_at", "ingest_date", "debezium_value"))


@query("stream_dedup")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once stream with redeliveries, then a replay of all of it -> one bronze row per coordinate."""
    src = _stream_source(spark, sf_dir, redeliver=True)
    bronze = scratch_path(spark, "bronze_dedup")
    for _ in range(2):  # the second run has a checkpoint of its own and reads everything again
        STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "stream_ckpt"), max_per_trigger=8)
    return L.read_lake_table(spark, bronze).select("topic", "kafka_partition", "kafka_offset", "ingest_id")


@query("land_out_of_order")
def q_land_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose broker times run backwards by years, default arguments: nothing is lost."""
    src, bronze = scratch_path(spark, "stream_source"), scratch_path(spark, "bronze_backwards")
    log = RV.change_log(spark, sf_dir)
    for day in range(3):  # equal thirds, each written after and stamped years before the last
        part = log.filter(F.pmod(F.col("offset"), F.lit(3)) == day)
        part.withColumn("timestamp", F.expr(f"timestamp - INTERVAL {day * 500} DAYS")).write.mode("append").option("compression", "zstd").parquet(src)
    STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "stream_ckpt"), max_per_trigger=8)
    return L.read_lake_table(spark, bronze).select("topic", "kafka_partition", "kafka_offset", "ingest_id")


# the newest broker time less this is the watermark of the second arrival
DEDUP_DELAY = "1000 days"


@query("stream_watermark_dedup")
def q_stream_watermark_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redeliveries dropped by the stream's own state; every 7th offset arrives later, and is lost behind the watermark."""
    src, out, checkpoint = (scratch_path(spark, p) for p in ("stream_source", "watermark_dedup", "stream_ckpt"))
    log = RV.change_log(spark, sf_dir, redeliver=True).withColumn("_later", F.col("offset") % 7 == 0)
    for later in (False, True):
        log.where(F.col("_later") == later).drop("_later").write.mode("append").option("compression", "zstd").parquet(src)
        # only what is compared or kept goes to the state
        seen = STREAM.read_change_stream(spark, src).select(*STREAM.COORDINATES, "timestamp")
        kept = STREAM.dedup_within_watermark(seen, DEDUP_DELAY)
        kept = kept.select("topic", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))
        with STREAM.state_on_disk(spark):
            query = kept.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query.awaitTermination()
    return spark.read.schema("topic string, kafka_partition int, kafka_offset long").parquet(out)


@query("replay_offset_ranges")
def q_replay_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The middle third of every topic partition's offsets read again as a batch and landed."""
    src, bronze = _stream_source(spark, sf_dir, redeliver=True), scratch_path(spark, "bronze_replay")
    ranges: dict[str, dict[int, tuple[int, int]]] = {}
    # one row per Kafka partition
    for r in spark.read.schema(KAFKA_ROW).parquet(src).groupBy("topic", "partition").agg(F.max("offset").alias("last")).collect():
        ranges.setdefault(r["topic"], {})[r["partition"]] = (r["last"] // 3, 2 * r["last"] // 3)
    JOBS.land_bronze_batch(STREAM.read_change_batch(spark, src, ranges), bronze, RV.AS_OF, mode="overwrite")
    return L.read_lake_table(spark, bronze, schema=BRONZE).select("topic", "kafka_partition", "kafka_offset", "ingest_id")


@query("stream_current_state")
def q_stream_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: current transactions kept by the stream, messages redelivered and stamped backwards, a few files per batch."""
    src, root = scratch_path(spark, "stream_source"), scratch_path(spark, "current_state")
    log = stored(RV.change_log(spark, sf_dir, redeliver=True))  # read once per third
    for third in range(3):
        part = log.filter(F.pmod(F.col("offset"), F.lit(3)) == third)
        part.withColumn("timestamp", F.expr(f"timestamp - INTERVAL {third * 500} DAYS")).write.mode("append").option("compression", "zstd").parquet(src)
    STATE.maintain_current_state(spark, src, root, scratch_path(spark, "stream_ckpt"), buckets=16, max_per_trigger=16)
    return comparable(STATE.current_transactions(spark, root))


def _arrival(column: str = "sale_ts"):
    """Arrival wave of a sale: years in order, but every 11th order of a year comes with the next wave or later."""
    order = F.split("transaction_id", "-")[0].cast("long")
    own = F.greatest(F.lit(0), F.floor((F.year(column) - 1992) / 2)).cast("int")
    return F.when(order % 11 == 0, F.least(own + 1, F.lit(DAILY_WAVES - 1))).otherwise(F.least(own, F.lit(DAILY_WAVES - 1)))


DAILY_WAVES = 4


@query("stream_daily_demand")
def q_stream_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: days closed by the watermark over four arrivals of sales, and the sales that came after their day was closed."""
    src, closed, late, checkpoint = (scratch_path(spark, p) for p in ("sales_stream", "closed_days", "late_sales", "daily_ckpt"))
    sales = stored(current_typed(spark, sf_dir).select("transaction_id", "store_id", "sku_id", "sale_ts", "units").withColumn("_wave", _arrival()))
    for wave in range(DAILY_WAVES):
        sales.filter(F.col("_wave") == wave).drop("_wave").write.mode("append").parquet(src)
        DAILY.drain_daily_demand(spark, src, closed, late, checkpoint)
    listed = DAILY.late_sales(spark, late).groupBy("store_id", "sku_id", F.to_date("sale_ts").alias("business_date")).agg(
        F.sum("units").cast("long").alias("units_sold"), F.count(F.lit(1)).alias("sales"))
    return DAILY.closed_days(spark, closed).withColumn("state", F.lit("closed")).unionByName(listed.withColumn("state", F.lit("late")))


# ------------------------------------------------------------------ silver


@query("silver_events")
def q_silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, canonical silver events of all four tables."""
    return comparable(silver_table(spark, sf_dir), drop=("silver_loaded_at", "ingested_at", "before_data"))


@query("operation_mix")
def q_operation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per table and operation, with names and flags."""
    return silver_table(spark, sf_dir).groupBy(
        "source_table", "operation", "operation_name", "is_snapshot", "is_deleted"
    ).agg(F.count(F.lit(1)).alias("events"))


@query("canonical_json")
def q_canonical_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw envelopes of all four topics (field order as produced) -> sorted, compact JSON."""
    from shelfcast.functions.json_fns import canonical_json

    return RV.change_log(spark, sf_dir).select(
        "topic", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
        canonical_json(F.col("value").cast("string")).alias("canonical_value"),
    )


@query("dedup_coordinates")
def q_dedup_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep the last landed copy of each Kafka coordinate, as the silver job does."""
    kept = S.silver_events(twice_landed_for_silver(spark, sf_dir), RV.AS_OF)
    return comparable(kept.select(F.col("kafka_topic").alias("topic"), "kafka_partition", "kafka_offset",
                                  F.col("event_id").alias("ingest_id"), "source_table", "operation", "ingested_at"))


@query("source_table_counts")
def q_source_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows per source table."""
    return silver_table(spark, sf_dir).groupBy("source_table").agg(F.count(F.lit(1)).alias("rows"))


@query("silver_summary")
def q_silver_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows (with redeliveries) vs silver rows after keep-last, and the mix."""
    bronze = twice_landed_for_silver(spark, sf_dir)
    silver = S.silver_events(bronze, RV.AS_OF)
    return silver.agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_distinct("source_table").alias("source_tables"),
        F.count_if("is_snapshot").alias("snapshot_events"),
        F.count_if("is_deleted").alias("delete_events"),
        F.min("event_date").alias("min_event_date"),
        F.max("event_date").alias("max_event_date"),
    ).select(bronze.select(F.count(F.lit(1))).scalar().alias("bronze_rows"), "*")


@query("run_metadata")
def q_run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job's summary row (scalars, a map, a struct, a date, a null) flattened."""
    counts = stored(silver_table(spark, sf_dir).groupBy("source_table").agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_date").alias("first"), F.max("event_date").alias("last")))
    # one row per source table
    by_table = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source_table", "rows"))))
    return META.flatten_summary(counts.agg(
        F.lit(JOBS.SILVER_MODE).alias("mode"), F.sum("rows").alias("silver_rows"), F.lit(True).alias("gate_passed"),
        F.lit(None).cast("string").alias("output_dir"), by_table.alias("source_table_counts"),
        F.struct(F.min("first").alias("min"), F.max("last").alias("max")).alias("date_range"), F.max("last").alias("last_event_date")))


# -------------------------------------------------------------------- gold


@query("sales_transactions_typed")
def q_sales_transactions_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every silver sales event parsed to the typed transaction frame."""
    return comparable(G.typed_sales(G.sales_events(filtered_silver_table(spark, sf_dir))))


@query("current_transactions")
def q_current_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per transaction, deletes dropped, then typed."""
    return comparable(G.current_transactions(filtered_silver_table(spark, sf_dir)))


@query("gold_daily_demand")
def q_gold_daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: gold over the full envelope -> bronze -> silver -> W2 chain."""
    silver = filtered_silver_table(spark, sf_dir)
    return comparable(G.gold_daily_demand(G.current_transactions(silver), RV.AS_OF), drop=("gold_loaded_at",))


@query("gold_summary")
def q_gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows, current transactions, gold rows and gold date range."""
    silver = stored_silver(spark, sf_dir)
    current = stored(G.current_transactions(silver, stored=True))
    gold = G.gold_daily_demand(current, RV.AS_OF)
    return gold.agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.min("business_date").alias("min_business_date"),
        F.max("business_date").alias("max_business_date"),
        F.sum("units_sold").alias("units_sold"),
    ).select(
        silver.select(F.count(F.lit(1))).scalar().alias("silver_rows"),
        current.select(F.count(F.lit(1))).scalar().alias("current_transaction_rows"),
        "*",
    )


@query("payload_violations")
def q_payload_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live sales whose payload misses a field or holds text for a number, counted per field.

    Broken here: units in multiples of 10 become text, net revenue goes missing from stockouts, the
    store of sales over 45 units becomes JSON null."""
    units = F.regexp_extract("record_data", '"units":([0-9]+)', 1).cast("int")
    silver = filtered_silver_table(spark, sf_dir)
    text = F.col("record_data")
    text = F.when(units % 10 == 0, F.regexp_replace(text, '"units":[0-9]+', '"units":"abc"')).otherwise(text)
    text = F.when(F.col("record_data").contains('"is_stockout":true'), F.regexp_replace(text, '"net_revenue":[^,}]*,?', "")).otherwise(text)
    text = F.when(units > 45, F.regexp_replace(text, '"store_id":"[^"]*"', '"store_id":null')).otherwise(text)
    return G.payload_checks(G.live_sales(silver.withColumn("record_data", text)))


@query("gold_append_after_delete")
def q_gold_append_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold, then every sale of a month's first day is deleted and gold is appended: those dates are gone."""
    first, second, gold = (scratch_path(spark, p) for p in ("silver_before", "silver_after", "gold_append"))
    L.write_lake_table(silver_table(spark, sf_dir), first)
    JOBS.build_gold(spark, first, gold, RV.AS_OF)
    silver = L.read_lake_table(spark, first)
    dead = G.typed_sales(G.live_sales(silver)).filter(F.dayofmonth("business_date") == 1).select("kafka_topic", "kafka_partition", "kafka_offset")
    deletes = (silver.join(dead, S.SILVER_COORDINATES).withColumn("operation", F.lit("d")).withColumn("operation_name", F.lit("delete"))
               .withColumn("is_deleted", F.lit(True)).withColumn("event_at", F.expr("event_at + INTERVAL 20000 DAYS"))
               .withColumn("kafka_offset", F.lit(-1) - F.col("kafka_offset")))
    L.write_lake_table(silver.unionByName(deletes.select(*silver.columns)), second)
    JOBS.build_gold(spark, second, gold, RV.AS_OF, mode="append")
    return comparable(L.read_lake_table(spark, gold), drop=("gold_loaded_at",))


# Payload fields that hold dates, by table.
DATE_FIELDS = [("sales_transactions", "business_date"), ("stores", "opened_on"), ("promotions", "start_date"), ("promotions", "end_date")]


@query("date_decoding")
def q_date_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload epoch-day integers -> dates, every date field of the four tables (distinct days)."""
    from shelfcast.functions import json_fns as J
    from shelfcast.functions.dates import variant_date

    parsed = silver_table(spark, sf_dir).select("source_table", J.parse("record_data").alias("p"))
    # a row decodes the fields of its own table only
    fields = F.array(*[F.when(F.col("source_table") == t, F.struct(
        F.lit(t).alias("source_table"), F.lit(f).alias("field"), J.path(F.col("p"), f"$.{f}", "int").alias("epoch_day"),
        variant_date(F.col("p"), f"$.{f}").alias("decoded"))) for t, f in DATE_FIELDS])
    found = parsed.select(F.explode(fields).alias("d"))
    return found.where("d is not null").select("d.*").distinct()


@query("inspect_table")
def q_inspect_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source_table of a written bronze table (file counts depend on the writer's tasks)."""
    path = scratch_path(spark, "inspect_bronze")
    JOBS.land_bronze_batch(RV.change_log(spark, sf_dir), path, RV.AS_OF, mode="overwrite")
    return L.inspect_table(spark, path, "source_table").drop("files")


@query("lakehouse_end_to_end")
def q_lakehouse_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land -> gate -> silver -> gate -> gold as written tables; gold read back."""
    paths = JOBS.LakehousePaths.under(scratch_path(spark, "lakehouse"))
    JOBS.run_lakehouse(RV.change_log(spark, sf_dir, redeliver=True), paths, RV.AS_OF)
    return comparable(L.read_lake_table(spark, paths.gold), drop=("gold_loaded_at",))


# ----------------------------------------------------------------- quality


@query("bronze_quality")
def q_bronze_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1-D11 over bronze after a redelivery: the uniqueness expectation fails."""
    return Q.evaluate(stored(landed_bronze_with_redelivery(spark, sf_dir)), Q.bronze_to_silver_suite())


@query("silver_quality")
def q_silver_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1-D11 over silver."""
    return Q.evaluate(stored(silver_table(spark, sf_dir)), Q.silver_to_gold_suite())


# Rows broken on purpose, by offset modulo 31: the column that becomes null, then bad values and duplicates.
BRONZE_NULLED = ["ingest_id", "ingested_at", "ingest_date", "topic", "kafka_partition", "kafka_offset", "source_schema", "source_table",
                 "operation", "event_ts_ms", "kafka_key", "debezium_value"]
SILVER_NULLED = ["event_id", "record_key", "source_schema", "source_table", "operation", "operation_name", "is_snapshot", "is_deleted",
                 "event_at", "event_date", "kafka_topic", "kafka_partition", "kafka_offset", "record_data", "ingested_at", "silver_loaded_at"]


def _broken(df: DataFrame, nulled: list[str], key: str, value: str) -> DataFrame:
    m = F.pmod(F.col("kafka_offset"), F.lit(31))
    bad = {"source_schema": (20, "other"), "source_table": (21, "unknown"), "operation": (22, "x"), key: (23, "not json"), value: (24, "{bad")}
    marked = df.unionByName(df.filter(m == 25)).withColumn("_m", m)
    out = {}
    for c in df.columns:
        col = F.col(c)
        if c in nulled:
            col = F.when(F.col("_m") != nulled.index(c), col)
        if c in bad:
            at, text = bad[c]
            col = F.when(F.col("_m") == at, F.lit(text)).otherwise(col)
        out[c] = col
    return marked.select(*[v.alias(k) for k, v in out.items()])


def broken_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broken(landed_bronze(spark, sf_dir), BRONZE_NULLED, "kafka_key", "debezium_value")


@query("bronze_quality_broken")
def q_bronze_quality_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2-D9 over bronze rows that break every rule."""
    return Q.evaluate(stored(broken_bronze(spark, sf_dir)), Q.bronze_to_silver_suite())


@query("silver_quality_broken")
def q_silver_quality_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2-D9 over silver rows that break every rule."""
    return Q.evaluate(stored(_broken(silver_table(spark, sf_dir), SILVER_NULLED, "record_key", "record_data")), Q.silver_to_gold_suite())


@query("gate_summary")
def q_gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's one-row summary over broken bronze."""
    row = Q.summarize(Q.evaluate(stored(broken_bronze(spark, sf_dir)), Q.bronze_to_silver_suite()))
    return row.withColumn("failure_messages", F.array_join("failure_messages", ";"))


@query("constraint_report")
def q_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, not-null, checks and foreign keys of the four tables."""
    return C.constraint_report(retail_tables(spark, sf_dir))


@query("fk_violations")
def q_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per foreign key, with the rows checked."""
    tables = retail_tables(spark, sf_dir)
    viol = C.foreign_key_violations(tables)
    checked = None
    for child, ccol, _parent, _pcol in C.FOREIGN_KEYS:
        part = tables[child].agg(F.count(ccol).alias("checked_rows")).select(
            F.lit(child).alias("child_table"), F.lit(ccol).alias("child_column"), "checked_rows")
        checked = part if checked is None else checked.unionByName(part)
    return viol.join(checked, ["child_table", "child_column"])


@query("inventory_cap_violations")
def q_inventory_cap_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """store/SKU/days whose units exceed inventory on hand."""
    return C.inventory_cap_violations(current_typed(spark, sf_dir))


@query("load_retail_tables")
def q_load_retail_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed loads of the four tables, refused when a constraint is violated."""
    tables = retail_tables(spark, sf_dir)
    report = C.constraint_report(tables)
    bad = report.filter(F.col("violations") > 0).select("table_name", "check_name").collect()
    if bad:
        raise ValueError(f"retail tables violate constraints: {[tuple(r) for r in bad]}")
    root = scratch_path(spark, "retail")
    out = None
    for name, df in tables.items():
        path = os.path.join(root, name)
        L.write_lake_table(df, path, "overwrite")
        part = L.read_lake_table(spark, path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- forecast


@query("demand_panel")
def q_demand_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense series x calendar panel, zero-filled."""
    return panel_of(spark, sf_dir)[0]


@query("evaluation_window")
def q_evaluation_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout window derived from the data."""
    return FC.evaluation_window(panel_of(spark, sf_dir)[0])


@query("train_test_split")
def q_train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, series and date bounds of each split."""
    panel, bounds = panel_of(spark, sf_dir)
    start, end = window_scalars(bounds)
    train, test = FC.split(panel, start, end)

    def stats(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(*FC.SERIES).alias("series"),
            F.min(FC.DATE).alias("min_date"), F.max(FC.DATE).alias("max_date"),
        ).select(F.lit(name).alias("split"), "*")

    return stats(train, "train").unionByName(stats(test, "test"))


@query("trailing_mean")
def q_trailing_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of each series' last season of train."""
    panel, bounds = panel_of(spark, sf_dir)
    start, end = window_scalars(bounds)
    train, _ = FC.split(panel, start, end)
    return FC.trailing_mean(train)


@query("seasonal_naive")
def q_seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal-naive forecast frame of the holdout."""
    return _forecasts(spark, sf_dir)


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel, bounds = panel_of(spark, sf_dir)
    start, end = window_scalars(bounds)
    return FC.seasonal_naive(panel, start, end, guard=False)


@query("forecast_metrics")
def q_forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error metrics in one aggregate (unrounded)."""
    return FC.forecast_metrics(_forecasts(spark, sf_dir))


@query("forecast_report")
def q_forecast_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the metrics as reported, rounded to 4 places by exact value."""
    return FC.rounded_report(FC.forecast_metrics(_forecasts(spark, sf_dir)))


@query("pinball_loss")
def q_pinball_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: pinball loss of the baseline at several quantiles."""
    fc = _forecasts(spark, sf_dir)
    a, p = F.col("actual_units"), F.col("forecast_units")
    row = fc.agg(*[FC.pinball_loss(a, p, q).alias(f"q{i}") for i, q in enumerate(PINBALL_QUANTILES)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(q).alias("quantile"), F.col(f"q{i}").alias("pinball_loss"))
        for i, q in enumerate(PINBALL_QUANTILES)
    ])).alias("r")).select("r.*")


@query("baseline_evaluation")
def q_baseline_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8/M2: checked end-to-end evaluation: window, panel size, forecasts, metrics."""
    panel, _ = panel_of(spark, sf_dir)
    window = FC.evaluation_window(panel).first()
    FC.validate_evaluation_window(window)
    fc = FC.seasonal_naive(panel, window["test_start"], window["test_end"], guard=False)
    return FC.forecast_metrics(fc).select(
        F.lit(FC.MODEL_NAME).alias("model"),
        F.lit(window["train_start"]).alias("train_start"),
        F.lit(window["test_start"]).alias("test_start"),
        F.lit(window["test_end"]).alias("test_end"),
        panel.select(F.count(F.lit(1))).scalar().alias("panel_rows"),
        "*",
    )


# ---------------------------------------------------------------- planning

# Replenishment period: sales are rare per day, an order covers four weeks.
ORDER_DAYS = 28


@query("conformal_intervals")
def q_conformal_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of the holdout with a 90 % band from the 28 days before it."""
    panel, bounds = panel_of(spark, sf_dir)
    return P.conformal_intervals(panel, *window_scalars(bounds))


@query("conformal_coverage")
def q_conformal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many holdout days the bands cover, against the target."""
    return P.coverage(q_conformal_intervals(spark, sf_dir))


@query("newsvendor_orders")
def q_newsvendor_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order quantity for four weeks per store and SKU at its critical ratio."""
    gold = gold_table(spark, sf_dir)
    return P.newsvendor(gold, RV.products(spark, sf_dir), FC.calendar_bounds(gold), period=ORDER_DAYS)


@query("policy_backtest")
def q_policy_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of seasonal-naive and newsvendor orders over three rolling origins."""
    gold = gold_table(spark, sf_dir)
    bounds, products = FC.calendar_bounds(gold), stored(RV.products(spark, sf_dir))
    return P.policy_cost(P.rolling_orders(gold, products, bounds, P.rolling_cutoffs(bounds), period=ORDER_DAYS), products)


# ----------------------------------------------------------------- history


@query("record_history")
def q_record_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals of every record of the four tables."""
    # read several times: the keys, the events, and the first of each day
    return comparable(H.record_history(stored_silver(spark, sf_dir)))


@query("gold_as_of_day")
def q_gold_as_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold with the store and product as known on the day."""
    gold = gold_table(spark, sf_dir).select("store_id", "sku_id", "business_date", "units_sold")
    tables = ["stores", "products"]
    bronze = B.bronze_rows(RV.change_log(spark, sf_dir, tables=tables), RV.AS_OF).where(F.col("topic").isin([RV.topic_for(t) for t in tables]) & F.col("source_table").isin(tables))
    dimensions = S.silver_events(bronze, RV.AS_OF)
    return comparable(H.enriched_gold(gold, stored(H.record_history(dimensions))))


# ----------------------------------------------------------------- drivers


@query("active_promotion")
def q_active_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold days with an active promotion (lowest id wins on overlap)."""
    gold = gold_table(spark, sf_dir).select("store_id", "sku_id", "business_date", "units_sold")
    out = D.active_promotion(gold, RV.promotions(spark, sf_dir), how="inner")
    return comparable(out)


@query("gold_promotions")
def q_gold_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gold day with the promotion active that day, or none."""
    gold = gold_table(spark, sf_dir).select("store_id", "sku_id", "business_date", "units_sold")
    return comparable(D.active_promotion(gold, RV.promotions(spark, sf_dir)))


@query("promotion_lift")
def q_promotion_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lift of each promotion from its discount, the product's elasticity and display."""
    promos = RV.promotions(spark, sf_dir)
    products = RV.products(spark, sf_dir).select("sku_id", "price_elasticity")
    joined = promos.join(products, "sku_id")
    return joined.select(
        "promotion_id", "sku_id", "store_id",
        D.promotion_lift(F.col("discount_pct"), F.col("price_elasticity"), F.col("feature_display"))
        .alias("promotion_lift"),
    )


@query("calendar_features")
def q_calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar drivers of every sales day."""
    days = gold_table(spark, sf_dir).select("business_date").distinct()
    start = days.select(F.min("business_date")).scalar()
    return D.calendar_features(days, start)


@query("expected_demand")
def q_expected_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected demand of each gold (store, SKU, day)."""
    gold = gold_table(spark, sf_dir).select("store_id", "sku_id", "business_date")
    start = gold.select(F.min("business_date")).scalar()
    return D.expected_demand(gold, RV.stores(spark, sf_dir), RV.products(spark, sf_dir),
                             RV.promotions(spark, sf_dir), start)


@query("stockout_flags")
def q_stockout_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory cap and stockout flag of each current transaction."""
    return D.stockout_flags(current_typed(spark, sf_dir))


@query("revenue_lines")
def q_revenue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effective price and gross / net revenue of each current transaction."""
    return comparable(D.revenue_lines(current_typed(spark, sf_dir)))
