"""Fixed schemas of every layer (column order is part of the contract)."""

from __future__ import annotations

from pyspark.sql import types as T

# Spark's Kafka source row shape; file-backed stand-ins use the same columns.
KAFKA_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

BRONZE = T.StructType(
    [
        T.StructField("ingest_id", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("source_schema", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("event_ts_ms", T.LongType()),
        T.StructField("source_lsn", T.LongType()),
        T.StructField("kafka_key", T.StringType()),
        T.StructField("debezium_value", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("record_key", T.StringType()),
        T.StructField("source_schema", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("operation_name", T.StringType()),
        T.StructField("is_snapshot", T.BooleanType()),
        T.StructField("is_deleted", T.BooleanType()),
        T.StructField("event_at", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("source_lsn", T.LongType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("before_data", T.StringType()),
        T.StructField("record_data", T.StringType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("silver_loaded_at", T.TimestampType()),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("units_sold", T.LongType()),
        T.StructField("transaction_count", T.LongType()),
        T.StructField("gross_revenue", T.DoubleType()),
        T.StructField("net_revenue", T.DoubleType()),
        T.StructField("avg_unit_price", T.DoubleType()),
        T.StructField("avg_discount_pct", T.DoubleType()),
        T.StructField("stockout_transaction_count", T.LongType()),
        T.StructField("stockout_rate", T.DoubleType()),
        T.StructField("promo_transaction_count", T.LongType()),
        T.StructField("promo_units", T.LongType()),
        T.StructField("first_sale_at", T.TimestampType()),
        T.StructField("last_sale_at", T.TimestampType()),
        T.StructField("source_event_count", T.LongType()),
        T.StructField("gold_loaded_at", T.TimestampType()),
    ]
)

FORECAST = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("cutoff_date", T.DateType()),
        T.StructField("model", T.StringType()),
        T.StructField("actual_units", T.DoubleType()),
        T.StructField("forecast_units", T.DoubleType()),
        T.StructField("error", T.DoubleType()),
        T.StructField("absolute_error", T.DoubleType()),
    ]
)

# Typed current-transaction frame between silver and gold (never stored).
CURRENT_TRANSACTION_COLUMNS = [
    "transaction_id",
    "store_id",
    "sku_id",
    "business_date",
    "sale_ts",
    "units",
    "unit_price",
    "discount_pct",
    "gross_revenue",
    "net_revenue",
    "inventory_on_hand",
    "is_stockout",
    "promotion_id",
    "source_event_count",
    "event_at",
    "source_lsn",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "is_deleted",
]

# Relational source tables (retail schema).
STORES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("store_format", T.StringType()),
        T.StructField("square_feet", T.IntegerType()),
        T.StructField("opened_on", T.DateType()),
        T.StructField("demand_multiplier", T.DecimalType(8, 4)),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("sku_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("unit_cost", T.DecimalType(10, 2)),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("shelf_life_days", T.IntegerType()),
        T.StructField("base_daily_demand", T.DecimalType(10, 3)),
        T.StructField("seasonality_strength", T.DecimalType(6, 3)),
        T.StructField("seasonal_phase", T.IntegerType()),
        T.StructField("price_elasticity", T.DecimalType(6, 3)),
    ]
)

PROMOTIONS = T.StructType(
    [
        T.StructField("promotion_id", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("discount_pct", T.DecimalType(5, 2)),
        T.StructField("feature_display", T.BooleanType()),
        T.StructField("campaign_name", T.StringType()),
    ]
)

SALES_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("sale_ts", T.TimestampType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("units", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount_pct", T.DecimalType(5, 2)),
        T.StructField("gross_revenue", T.DecimalType(12, 2)),
        T.StructField("net_revenue", T.DecimalType(12, 2)),
        T.StructField("inventory_on_hand", T.IntegerType()),
        T.StructField("is_stockout", T.BooleanType()),
        T.StructField("promotion_id", T.StringType()),
    ]
)

RETAIL_TABLE_SCHEMAS = {
    "stores": STORES,
    "products": PRODUCTS,
    "promotions": PROMOTIONS,
    "sales_transactions": SALES_TRANSACTIONS,
}

# Primary key of each retail table (also the CDC message key).
PRIMARY_KEYS = {
    "stores": "store_id",
    "products": "sku_id",
    "promotions": "promotion_id",
    "sales_transactions": "transaction_id",
}

# The retail change topics, one per table.
DEFAULT_TOPICS = [f"shop.retail.{table}" for table in RETAIL_TABLE_SCHEMAS]
