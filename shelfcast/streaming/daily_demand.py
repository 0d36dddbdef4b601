"""E5: daily demand over a stream of sales, closed by watermark, with the late rows listed.

Sales are summed in one-day event-time windows per store and SKU.  A day is final once
the watermark - the latest sale seen less ``delay`` - has passed its end; then its row is
appended and never changes.  Sales of a day that is already closed are late: Spark leaves
them out of the windows, so a second reader of the same files writes them to a table of
their own, by the same rule and with the same watermark.

One call drains what has arrived since the last one.  Late rows are listed before the
windows move on; the watermark is noted beside the checkpoint only after both are done.
A drain that failed is run again before new files are added; it then lists the same rows
(its batch folder is overwritten) and the window query goes on from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources import lakehouse as L

SALES_SCHEMA = "transaction_id string, store_id string, sku_id string, sale_ts timestamp, units int"
CLOSED_SCHEMA = "store_id string, sku_id string, business_date date, units_sold long, sales long"
DELAY = "2 days"
MARK = "watermark"


def day_end(ts: Column) -> Column:
    return F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")


def _sales(spark: SparkSession, source: str) -> DataFrame:
    # rows without a time belong to no day
    return spark.readStream.schema(SALES_SCHEMA).parquet(source).where("sale_ts IS NOT NULL")


def _drain(writer, checkpoint: str):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_daily_demand(spark: SparkSession, source: str, closed_path: str, late_path: str, checkpoint: str, delay: str = DELAY) -> dict:
    """Close the days the new files allow; returns the watermark (epoch ms) and the rows listed as late."""
    mark = f"{checkpoint.rstrip('/')}.{MARK}"
    watermark = int(L.read_small_file(spark, mark) or 0)
    found = {"late": 0}

    def list_late(batch: DataFrame, batch_id: int) -> None:
        late = batch.where(F.unix_millis(day_end(F.col("sale_ts"))) <= watermark).persist()
        try:
            found["late"] += late.count()
            late.write.mode("overwrite").parquet(f"{late_path}/batch={batch_id}")
        finally:
            late.unpersist()

    _drain(_sales(spark, source).writeStream.foreachBatch(list_late), f"{checkpoint}-late")
    days = (_sales(spark, source).withWatermark("sale_ts", delay).groupBy(F.window("sale_ts", "1 day").alias("day"), "store_id", "sku_id")
            .agg(F.sum("units").cast("long").alias("units_sold"), F.count(F.lit(1)).alias("sales")))
    rows = days.select("store_id", "sku_id", F.to_date("day.start").alias("business_date"), "units_sold", "sales")

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{closed_path}/batch={batch_id}")

    query = _drain(rows.writeStream.outputMode("append").foreachBatch(append), f"{checkpoint}-days")
    seen = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in (p.get("eventTime") or {})]
    if seen:
        moved = spark.sql("SELECT unix_millis(to_timestamp(:w))", args={"w": max(seen)}).first()[0]
        watermark = max(watermark, moved)
        L.write_small_file(spark, mark, str(watermark))
    return {"watermark_ms": watermark, "late_rows": found["late"]}


def closed_days(spark: SparkSession, closed_path: str) -> DataFrame:
    return spark.read.schema(CLOSED_SCHEMA).parquet(f"{closed_path}/batch=*")


def late_sales(spark: SparkSession, late_path: str) -> DataFrame:
    return spark.read.schema(SALES_SCHEMA).parquet(f"{late_path}/batch=*")
