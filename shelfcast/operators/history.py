"""Versions of every record in time, and gold as it looked on the day.

E6 turns change events into validity intervals: a version holds from its event until the
next event of the same key; a delete ends the version before it and is none itself.
E4 joins gold days with the store and product versions known at the end of the day.

A key with very many events is not gathered: neighbours are found within (key, day of
the event), and across days by the first event of each day, one narrow row per key and day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import json_fns as J
from shelfcast.operators.repeated import repeated_or_marked, split_by_repeated

KEY = ["source_table", "record_key"]
ORDER = ["event_at", "_late", "source_lsn", "kafka_topic", "kafka_partition", "kafka_offset"]


def record_history(silver: DataFrame) -> DataFrame:
    """(source_table, record_key, valid_from, valid_to, record_data); ``valid_to`` is null for the version in force.

    Events of one instant follow each other in (lsn, topic, partition, offset) order, so an overtaken
    one has an empty interval and is left out.  Events without time or key have no place and are left out.
    The only event of a key has no neighbours: which keys have more is found first, and only their events are dealt out.
    """
    events = silver.where("event_at IS NOT NULL AND record_key IS NOT NULL").select(
        *KEY, F.col("event_at"), F.col("source_lsn").isNull().alias("_late"), "source_lsn", "kafka_topic", "kafka_partition", "kafka_offset",
        F.to_date("event_at").alias("_day"), "is_deleted", "record_data")
    repeated = repeated_or_marked(events, KEY)
    once, again = (None, events) if repeated is None else (events, None) if repeated == [] else split_by_repeated(events, KEY, repeated)
    parts = [] if once is None else [once.withColumn("valid_to", F.lit(None).cast("timestamp")).select(*ENDED)]
    parts += [] if again is None else [_ended(again)]
    ended = reduce(DataFrame.unionByName, parts)
    return ended.where(~F.col("is_deleted") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("event_at")))).select(
        *KEY, F.col("event_at").alias("valid_from"), "valid_to", "record_data")


ENDED = [*KEY, "event_at", "valid_to", "is_deleted", "record_data"]


def _ended(events: DataFrame) -> DataFrame:
    """``events`` with the time of the next event of their key."""
    inside = Window.partitionBy(*KEY, "_day").orderBy(*ORDER)
    paired = events.withColumn("_next", F.lead("event_at").over(inside))
    firsts = events.groupBy(*KEY, "_day").agg(F.min("event_at").alias("_first"))
    following = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*KEY).orderBy("_day"))).drop("_first")
    ends = F.coalesce("_next", "_after")
    return paired.join(following, [*KEY, "_day"]).withColumn("valid_to", ends).select(*ENDED)


def _months(start: Column, end: Column) -> Column:
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))


def as_of_day(days: DataFrame, versions: DataFrame, key: str, fields: dict[str, Column], date_column: str = "business_date") -> DataFrame:
    """``days`` with ``fields`` of the version of ``key`` in force at the end of the day; null before its first version.

    Versions are laid out by the calendar months they cover (within those of the days), so the join is
    an equality on (key, month) and a store or SKU with very many days is spread over its months.
    """
    span = days.agg(F.min(date_column).alias("lo"), F.max(date_column).alias("hi")).first()
    first, last = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    opened = F.greatest(F.to_date("valid_from"), first)
    closed = F.least(F.coalesce(F.to_date("valid_to"), last), last)
    laid = (versions.where(opened <= closed).withColumn("_month", F.explode(_months(opened, closed)))
            .select(F.col(key).alias("_key"), "_month", "valid_from", "valid_to", *[c.alias(n) for n, c in fields.items()]))
    end = F.date_add(F.col(date_column), 1).cast("timestamp")
    held = (F.col(key) == F.col("_key")) & (F.trunc(date_column, "month") == F.col("_month")) & (F.col("valid_from") < end) & (
        F.col("valid_to").isNull() | (F.col("valid_to") >= end))
    return days.join(laid, held, "left").drop("_key", "_month", "valid_from", "valid_to")


def enriched_gold(gold: DataFrame, history: DataFrame) -> DataFrame:
    """Gold with the store's region and format and the product's category and price as of the day."""
    def versions(table: str, key: str) -> DataFrame:
        rows = history.where(F.col("source_table") == table)
        return rows.withColumn("_p", J.parse("record_data")).withColumn(key, J.path(J.parse("record_key"), f"$.{key}"))

    p = F.col("_p")
    stores = as_of_day(gold, versions("stores", "store_id"), "store_id", {
        "region": J.path(p, "$.region"), "store_format": J.path(p, "$.store_format")})
    return as_of_day(stores, versions("products", "sku_id"), "sku_id", {
        "category": J.path(p, "$.category"), "list_price": J.path(p, "$.unit_price", "decimal(10,2)")})
