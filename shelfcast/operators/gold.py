"""Silver -> current sales transactions -> gold daily demand per store, SKU and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import json_fns as J
from shelfcast.functions.dates import variant_date, variant_timestamp
from shelfcast.operators.repeated import keep_last_where_repeated, repeated_or_marked
from shelfcast.schemas import CURRENT_TRANSACTION_COLUMNS, GOLD

SALES_TABLE = "sales_transactions"
GROUP_KEYS = ["store_id", "sku_id", "business_date"]
# A live sale must carry these; only the promotion may be absent.
REQUIRED_FIELDS = ["transaction_id", "store_id", "sku_id", "business_date", "sale_ts", "units", "unit_price", "discount_pct",
                   "gross_revenue", "net_revenue", "inventory_on_hand", "is_stockout"]
EVENT_ORDER_COLUMNS = ["event_at", "source_lsn", "kafka_topic", "kafka_partition", "kafka_offset"]


def _as_ts(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def event_order_key() -> list[Column]:
    """Ascending event order; a null LSN sorts after every LSN of the same instant."""
    return [
        F.col("event_at").alias("_k0"),
        F.col("source_lsn").isNull().alias("_k1"),
        F.col("source_lsn").alias("_k2"),
        F.col("kafka_topic").alias("_k3"),
        F.col("kafka_partition").alias("_k4"),
        F.col("kafka_offset").alias("_k5"),
    ]


def latest_per_key(events: DataFrame, key: str | list[str], carry: list[str]) -> DataFrame:
    """The last event of each key in (event_at, lsn, topic, partition, offset) order.

    ``max(struct(order..., payload...))`` is an aggregate, so Spark combines it
    map-side before the shuffle: a key with a third of all rows still reaches the
    reducer as one row per map task.  Null keys form one group.  What the order holds
    is not carried beside it a second time.
    """
    ordered = dict(zip(EVENT_ORDER_COLUMNS, ["_k0", "_k2", "_k3", "_k4", "_k5"], strict=True))
    packed = F.struct(*event_order_key(), *[F.col(c) for c in carry if c not in ordered])
    keys = [key] if isinstance(key, str) else key
    return events.groupBy(*keys).agg(F.max(packed).alias("_w")).select(
        *keys, *[F.col(f"_w.{ordered.get(c, c)}").alias(c) for c in carry]
    )


def transaction_key() -> Column:
    """Key from the message key; the payload's id only when the key lacks it."""
    from_key = J.path(J.parse("record_key"), "$.transaction_id")
    return F.coalesce(from_key, J.path(J.parse("record_data"), "$.transaction_id"))


def typed_sales(events: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Parse ``record_data`` of sales events into the typed transaction frame (``carry``: columns kept beside it)."""
    staged = events.withColumn("_p", J.parse("record_data"))
    p = F.col("_p")
    return staged.select(
        J.path(p, "$.transaction_id").alias("transaction_id"),
        J.path(p, "$.store_id").alias("store_id"),
        J.path(p, "$.sku_id").alias("sku_id"),
        variant_date(p, "$.business_date").alias("business_date"),
        variant_timestamp(p, "$.sale_ts").alias("sale_ts"),
        J.path(p, "$.units", "int").alias("units"),
        J.path(p, "$.unit_price", "decimal(10,2)").alias("unit_price"),
        J.path(p, "$.discount_pct", "decimal(5,2)").alias("discount_pct"),
        J.path(p, "$.gross_revenue", "decimal(12,2)").alias("gross_revenue"),
        J.path(p, "$.net_revenue", "decimal(12,2)").alias("net_revenue"),
        J.path(p, "$.inventory_on_hand", "int").alias("inventory_on_hand"),
        J.path(p, "$.is_stockout", "boolean").alias("is_stockout"),
        J.path(p, "$.promotion_id").alias("promotion_id"),
        F.lit(1).cast("long").alias("source_event_count"),
        F.col("event_at"),
        F.col("source_lsn"),
        F.col("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col("is_deleted"),
        *[F.col(c) for c in carry or []],
    )


def sales_events(silver: DataFrame) -> DataFrame:
    """sales events only (prunes the ``source_table`` partitions of a stored silver)."""
    return silver.filter(F.col("source_table") == SALES_TABLE)


def live_sales(silver: DataFrame, stored: bool = False) -> DataFrame:
    """F1 -> W2 -> F2: the latest event of every live sales transaction, payload still text.

    The latest event is chosen before any payload is parsed and deletes are
    dropped, so a delete carrying only key columns never reaches the typed parse.
    Where silver is ``stored`` its keys are read by themselves first: a transaction's
    only event is its latest and is not shuffled.
    """
    carry = [*EVENT_ORDER_COLUMNS, "is_deleted", "record_data"]
    sales = sales_events(silver).select(transaction_key().alias("_tid"), *carry)
    repeated = repeated_or_marked(sales, ["_tid"]) if stored else None
    latest = keep_last_where_repeated(sales, ["_tid"], repeated, lambda some: latest_per_key(some, "_tid", carry))
    return latest.filter(~F.col("is_deleted"))


def current_transactions(silver: DataFrame, stored: bool = False) -> DataFrame:
    """F1 -> W2 -> F2 -> P13: the current state of every live sales transaction (``stored``: see ``live_sales``)."""
    return typed_sales(live_sales(silver, stored)).select(*CURRENT_TRANSACTION_COLUMNS)


def payload_checks(live: DataFrame) -> DataFrame:
    """One row, how many live sales lack each required field or hold a value of another type."""
    typed = typed_sales(live)
    return typed.agg(F.count(F.lit(1)).alias("live_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_FIELDS])


def current_from_typed_events(events: DataFrame) -> DataFrame:
    """W2 + F2 over already-typed change events (no JSON on this path)."""
    payload = [c for c in events.columns if c not in ("transaction_id", *EVENT_ORDER_COLUMNS)]
    staged = events.withColumn("event_at", F.timestamp_millis(F.col("event_ts_ms")))
    carry = [*EVENT_ORDER_COLUMNS, *payload]
    latest = latest_per_key(staged, "transaction_id", carry)
    return latest.filter(F.col("operation") != "d").withColumn("source_event_count", F.lit(1).cast("long"))


def gold_daily_demand(transactions: DataFrame, loaded_at: Column | str) -> DataFrame:
    """A1: one row per (store, SKU, day) of current transactions.

    Money stays decimal through the sums (exact, order-independent) and turns
    double once.  Means are sum/count over the non-null values.  Rows with a null
    group key are dropped first.  ``transaction_count`` counts ids: after W2 each
    id occurs once, so a plain count equals the distinct count without the extra
    distinct-aggregation shuffle.
    """
    tx = transactions.dropna(subset=GROUP_KEYS)
    units = F.col("units")
    has_promo = F.col("promotion_id").isNotNull()
    agg = tx.groupBy(*GROUP_KEYS).agg(
        F.sum(units).cast("long").alias("units_sold"),
        F.count("transaction_id").alias("transaction_count"),
        F.sum("gross_revenue").cast("double").alias("gross_revenue"),
        F.sum("net_revenue").cast("double").alias("net_revenue"),
        F.try_divide(F.sum("unit_price").cast("double"), F.count("unit_price")).alias("avg_unit_price"),
        F.try_divide(F.sum("discount_pct").cast("double"), F.count("discount_pct")).alias("avg_discount_pct"),
        F.count_if(F.col("is_stockout")).cast("long").alias("stockout_transaction_count"),
        F.count("promotion_id").alias("promo_transaction_count"),
        F.sum(F.when(has_promo, units).otherwise(F.lit(0))).cast("long").alias("promo_units"),
        F.min("sale_ts").alias("first_sale_at"),
        F.max("sale_ts").alias("last_sale_at"),
        F.sum("source_event_count").cast("long").alias("source_event_count"),
    )
    out = agg.withColumn(
        "stockout_rate",
        F.try_divide(F.col("stockout_transaction_count").cast("double"), F.col("transaction_count")),
    ).withColumn("gold_loaded_at", _as_ts(loaded_at))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in GOLD.fields])
