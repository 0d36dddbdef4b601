"""Silver and gold appends that read what is new and rewrite what it touches.

Each step keeps a high-water mark beside its target: the newest modification time among
the source files it has seen.  The next run lists only files from ``overlap`` before it on: a
file keeps the time it was written, not the time its job committed, so the overlap must be
longer than a writer that runs at the same time takes.  Files seen twice do no harm, because
silver leaves out coordinates it holds and gold works on transactions whose latest event differs
from the one stored.  The mark moves only after the target is written, so a run that failed
is simply run again.

Gold needs the old place of a changed sale.  Two helper tables beside it answer that
without a scan of silver, both in committed batch folders of which the newest version per
partition counts: the latest event per transaction in buckets of its key, and the live
sales by month.  A run reads the buckets of the changed transactions, takes from them the
dates they leave and the dates they enter, and rewrites gold for those dates only.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.errors import GoldTransformError, SilverTransformError
from shelfcast.operators import gold as G
from shelfcast.operators import quality as Q
from shelfcast.operators import silver as S
from shelfcast.plans import jobs as J
from shelfcast.schemas import BRONZE, SILVER
from shelfcast.sources import lakehouse as L
from shelfcast.streaming import current_state as STATE

MARK_SUFFIX = ".mark"
OVERLAP = timedelta(hours=1)
SALES_SCHEMA = (f"{STATE.KEY} string, transaction_id string, store_id string, sku_id string, business_date date, sale_ts timestamp, units int, "
                "unit_price decimal(10,2), discount_pct decimal(5,2), gross_revenue decimal(12,2), net_revenue decimal(12,2), "
                "inventory_on_hand int, is_stockout boolean, promotion_id string, source_event_count long")


def files_since_mark(spark: SparkSession, path: str, schema, target: str, overlap: timedelta = OVERLAP) -> tuple[DataFrame, str | None]:
    """Rows of the files of ``path`` that are newer than the mark of ``target``, and the mark they will leave (None: no file)."""
    mark = L.read_small_file(spark, target.rstrip("/") + MARK_SUFFIX)
    reader = spark.read.schema(schema)
    if mark:
        since = datetime.fromisoformat(mark) - overlap
        zone = spark.conf.get("spark.sql.session.timeZone")
        reader = reader.option("modifiedAfter", since.isoformat()).option("timeZone", zone)
    rows = reader.parquet(path)
    newest = rows.select(F.unix_millis(F.max("_metadata.file_modification_time"))).first()[0]
    return rows, datetime.fromtimestamp(newest / 1000, UTC).replace(tzinfo=None).isoformat() if newest is not None else mark


def _set_mark(spark: SparkSession, target: str, mark: str | None) -> None:
    if mark:
        L.write_small_file(spark, target.rstrip("/") + MARK_SUFFIX, mark)


def not_yet_in_silver(bronze: DataFrame, silver_path: str) -> DataFrame:
    """Bronze rows whose coordinate silver does not hold; only silver's row groups in their offset ranges are read."""
    spark = bronze.sparkSession
    if not L.table_exists(spark, silver_path):
        return bronze
    ranges = bronze.groupBy("topic", "kafka_partition").agg(F.min("kafka_offset").alias("lo"), F.max("kafka_offset").alias("hi")).collect()
    overlap = F.lit(False)
    for r in ranges:
        overlap = overlap | (F.col("kafka_topic").eqNullSafe(r["topic"]) & F.col("kafka_partition").eqNullSafe(r["kafka_partition"])
                             & F.col("kafka_offset").between(r["lo"], r["hi"]))
    seen = L.read_lake_table(spark, silver_path, schema=SILVER).filter(overlap).select(F.col("event_id").alias("ingest_id"))
    return bronze.join(seen, "ingest_id", "left_anti")


def append_silver(spark: SparkSession, bronze_path: str, silver_path: str, loaded_at: str, overlap: timedelta = OVERLAP) -> dict[str, Any]:
    """Silver events of the bronze files landed since the last run; the gate judges those rows."""
    with J.layer_errors(SilverTransformError, f"Bronze table {bronze_path} cannot be read"):
        fresh, mark = files_since_mark(spark, bronze_path, BRONZE, silver_path, overlap)
    new = not_yet_in_silver(fresh, silver_path).persist()
    try:
        gate = Q.gate(new, Q.bronze_to_silver_suite()) if new.head(1) else None
        rows = 0
        if gate:
            silver = S.silver_events(new, loaded_at)
            silver, written = J._written_metrics(silver, [F.count(F.lit(1)).alias("rows")])
            L.write_lake_table(silver, silver_path, "append", J.SILVER_PARTITIONS, sort_within=["event_at", *S.SILVER_COORDINATES])
            rows = written.get["rows"]
    finally:
        new.unpersist()
    _set_mark(spark, silver_path, mark)
    return {"bronze_table_uri": bronze_path, "silver_table_uri": silver_path, "mode": "append", "appended_rows": rows,
            "quality_gate": gate.to_dict() if gate else None}


@dataclass(frozen=True)
class GoldState:
    """Folders of the helper tables: latest event per transaction, and live sales by month of the business date."""

    events: str
    sales: str
    buckets: int = STATE.BUCKETS

    @classmethod
    def beside(cls, gold_path: str, buckets: int = STATE.BUCKETS) -> GoldState:
        base = gold_path.rstrip("/")
        return cls(f"{base}.events", f"{base}.sales", buckets)


def typed_sales_by_key(events: DataFrame) -> DataFrame:
    """Latest events, one per key -> the typed live sales among them, with their key."""
    return G.typed_sales(events.filter(~F.col("is_deleted")), carry=[STATE.KEY]).select(*[c.split()[0] for c in SALES_SCHEMA.split(", ")])


def append_gold(spark: SparkSession, silver_path: str, gold_path: str, loaded_at: str, state: GoldState | None = None,
                overlap: timedelta = OVERLAP) -> dict[str, Any]:
    """Gold of the business dates that the silver files since the last run touch; all other dates stay as they are.

    A touched date whose sales are all gone loses its partition.  New live sales with a missing or
    unusable field stop the run before anything is written."""
    state = state or GoldState.beside(gold_path)
    with J.layer_errors(GoldTransformError, f"Silver table {silver_path} cannot be read"):
        fresh, mark = files_since_mark(spark, silver_path, SILVER, gold_path, overlap)
    sales = G.sales_events(fresh)
    new = G.latest_per_key(sales.withColumn(STATE.KEY, G.transaction_key()), STATE.KEY, STATE.CARRIED).persist()
    after = None
    try:
        summary = {"silver_table_uri": silver_path, "gold_daily_demand_table_uri": gold_path, "mode": "append", "changed_transactions": 0,
                   "touched_dates": [], "gone_dates": []}
        touched = STATE.touched_buckets(new, state.buckets)
        if touched:
            Q.gate(fresh, Q.silver_to_gold_suite())
        before = STATE.stored_events(spark, state.events, touched)
        place = [STATE.KEY, "kafka_topic", "kafka_partition", "kafka_offset"]
        latest = G.latest_per_key(before.join(new, STATE.KEY, "left_semi").unionByName(new.select(*before.columns)), STATE.KEY, STATE.CARRIED)
        after = latest.join(before.select(*place), place, "left_anti").persist()
        summary["changed_transactions"] = after.count()
        if not summary["changed_transactions"]:
            _set_mark(spark, gold_path, mark)
            return summary
        checks = G.payload_checks(after.filter(~F.col("is_deleted"))).first().asDict()
        broken = {k: v for k, v in checks.items() if k != "live_rows" and v}
        if broken:
            raise GoldTransformError("New live sales with unusable payload fields: " + ", ".join(f"{k} ({v} rows)" for k, v in sorted(broken.items())))
        # one batch number for both helper tables; a run that failed half-way is repeated under a new one
        batch = max(STATE.next_batch(spark, state.events), STATE.next_batch(spark, state.sales))
        known = STATE.committed_parts(spark, state.sales)
        keys = after.select(STATE.KEY)
        entering = typed_sales_by_key(after).dropna(subset=G.GROUP_KEYS)
        leaving = typed_sales_by_key(before.join(keys, STATE.KEY, "left_semi"))
        dates = sorted(r[0] for r in entering.select("business_date").unionByName(leaving.select("business_date")).distinct().collect() if r[0])
        months = sorted({d.strftime("%Y-%m") for d in dates})
        stored = STATE.read_parts(spark, [known[m] for m in months if m in known], SALES_SCHEMA).where(f"{STATE.KEY} IS NOT NULL")
        held = stored.join(keys, STATE.KEY, "left_anti").unionByName(entering)
        # a row without key stands for the month itself, so that an emptied month has a newest version too
        marks = spark.createDataFrame([(d,) for d in dates], "business_date date")
        version = held.unionByName(marks, allowMissingColumns=True).withColumn("_month", F.date_format("business_date", "yyyy-MM"))
        version.hint("rebalance", "_month").write.mode("overwrite").partitionBy("_month").parquet(f"{state.sales}/batch={batch}")
        now = STATE.committed_parts(spark, state.sales)
        current = STATE.read_parts(spark, [now[m] for m in months], SALES_SCHEMA).where(f"{STATE.KEY} IS NOT NULL").join(
            marks, "business_date", "left_semi")
        gold = G.gold_daily_demand(current, loaded_at)
        L.write_lake_table(gold, gold_path, "dynamic", J.GOLD_PARTITIONS, sort_within=["store_id", "sku_id"])
        left = {r[0] for r in current.select("business_date").distinct().collect()}
        gone = [d for d in dates if d not in left]
        L.drop_partitions(spark, gold_path, "business_date", gone)
        # last: while the old events are still in force, a repeated run finds the dates again
        STATE.merge_events(after, batch, state.events, state.buckets)
        STATE.drop_superseded(spark, state.events, batch)
        STATE.drop_superseded(spark, state.sales, batch)
        _set_mark(spark, gold_path, mark)
        return summary | {"touched_dates": dates, "gone_dates": gone}
    finally:
        new.unpersist()
        if after is not None:
            after.unpersist()
