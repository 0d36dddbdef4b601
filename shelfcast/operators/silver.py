"""Bronze -> silver: typed change events, de-duplicated on Kafka coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.functions import json_fns as J
from shelfcast.operators.bronze import ENVELOPE, event_ts_ms
from shelfcast.operators.repeated import keep_last_where_repeated, repeated_or_marked
from shelfcast.schemas import SILVER

COORDINATES = ["topic", "kafka_partition", "kafka_offset"]

# Fixed values (must equal the model's): change operation codes and their names.
OPERATION_NAMES = {
    "r": "snapshot_read",
    "c": "create",
    "u": "update",
    "d": "delete",
}
# Source.snapshot markers that count as a snapshot read.
SNAPSHOT_MARKERS = ["true", "first", "last"]


def _as_ts(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def keep_last_per_coordinate(rows: DataFrame, coordinates: list[str] | None = None,
                             order: list[str] | None = None) -> DataFrame:
    """One row per (topic, partition, offset), the last delivered copy winning.

    Spark rows have no input order, so "last" is the latest ``ingested_at``, ties
    broken by the payload text.  Rows with null coordinates group together.
    ``max`` aggregates before the shuffle unless the rows are already partitioned
    by coordinate; the order's columns, texts among them, are held once and not
    beside the row they belong to.
    """
    coords = coordinates or COORDINATES
    order = order or ["ingested_at", "debezium_value"]
    others = [c for c in rows.columns if c not in coords and c not in order]
    winner = F.max(F.struct(*order, *others))
    return rows.groupBy(*coords).agg(winner.alias("_w")).select(
        *[F.col(c) if c in coords else F.col(f"_w.{c}").alias(c) for c in rows.columns]
    )


def operation_name(op: Column, strict: bool = True) -> Column:
    names = F.create_map(*[F.lit(x) for kv in OPERATION_NAMES.items() for x in kv])
    name = F.element_at(names, op)
    if not strict:
        return name
    return F.when(name.isNotNull(), name).otherwise(
        F.raise_error(F.concat(F.lit("Unknown change operation: "), F.coalesce(op, F.lit("NULL"))))
    )


def silver_rows(bronze: DataFrame, loaded_at: Column | str, strict: bool = True,
                observe: tuple[Observation, list[Column]] | None = None) -> DataFrame:
    """P5-P12 as projections over the parsed envelope (parsed once per row, and not
    again where the bronze rows still carry it).

    ``observe`` attaches gate metrics to this pass: ``(observation, aggregates)``
    where the aggregates may read the parsed ``_v`` (envelope) and ``_k`` (key).
    """
    carried = ENVELOPE in bronze.columns
    staged = bronze if carried else bronze.withColumn(ENVELOPE, J.parse("debezium_value"))
    staged = staged.withColumn("_k", J.parse("kafka_key"))
    if observe:
        staged = staged.observe(observe[0], *observe[1])
    v = F.col("_v")
    staged = staged.select(
        "*",
        # rows that carry their envelope carry what bronze has read from it as well
        (F.col("operation") if carried else J.path(v, "$.op")).alias("_op"),
        (F.col("event_ts_ms") if carried else event_ts_ms(v)).alias("_ts"),
    )
    op = F.col("_op")
    event_at = F.timestamp_millis(F.col("_ts"))
    is_delete = op == "d"
    before, after = J.sub_to_json(v, "$.before"), J.sub_to_json(v, "$.after")
    snapshot = F.lower(J.path(v, "$.source.snapshot"))

    def source(name: str) -> Column:
        column = F.col(f"source_{name}")
        return column if carried else F.coalesce(F.nullif(J.path(v, f"$.source.{name}"), F.lit("")), column)

    out = staged.select(
        F.col("ingest_id").alias("event_id"),
        J.canonical_text("kafka_key", F.col("_k")).alias("record_key"),
        source("schema").alias("source_schema"),
        source("table").alias("source_table"),
        op.alias("operation"),
        operation_name(op, strict).alias("operation_name"),
        F.coalesce(snapshot.isin(SNAPSHOT_MARKERS), F.lit(False)).alias("is_snapshot"),
        F.coalesce(is_delete, F.lit(False)).alias("is_deleted"),
        event_at.alias("event_at"),
        F.to_date(event_at).alias("event_date"),
        (F.col("source_lsn") if carried else J.path(v, "$.source.lsn", "bigint")).alias("source_lsn"),
        F.col("topic").alias("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        before.alias("before_data"),
        F.when(is_delete, before).otherwise(after).alias("record_data"),
        F.col("ingested_at"),
        _as_ts(loaded_at).alias("silver_loaded_at"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in SILVER.fields])


SILVER_COORDINATES = ["kafka_topic", "kafka_partition", "kafka_offset"]


def silver_events(bronze: DataFrame, loaded_at: Column | str, strict: bool = True,
                  observe: tuple[Observation, list[Column]] | None = None) -> DataFrame:
    """Bronze -> silver: each row is parsed once into silver columns, then W1 keeps
    the last copy per coordinate.  Only text and scalars cross the shuffle, and a
    later filter on a silver column (e.g. ``source_table``) reads a plain field.

    Which coordinates repeat is found first, from their hashes: rows that came once
    are not shuffled, whether few repeat or many.  Copies of a coordinate are reduced before the shuffle, so one
    delivered very often does not meet in one task, and the envelope text never crosses it."""
    repeated = repeated_or_marked(bronze, COORDINATES)
    if observe and repeated != []:
        repeated = None  # the observed rows are read once
    return _last_events(silver_rows(bronze, loaded_at, strict, observe), repeated)


def last_events(rows: DataFrame) -> DataFrame:
    """W1 over silver rows that are stored: their own coordinates are looked at, nothing before them is made again."""
    return _last_events(rows, repeated_or_marked(rows, SILVER_COORDINATES))


def _last_events(rows: DataFrame, repeated: list[int] | DataFrame | None) -> DataFrame:
    return keep_last_where_repeated(rows, SILVER_COORDINATES, repeated, lambda some: keep_last_per_coordinate(
        some, SILVER_COORDINATES, ["ingested_at", "record_data", "before_data"]))
