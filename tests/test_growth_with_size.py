"""How much is read, dealt out and written as tables grow: files, copies and passes."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import bronze as B
from shelfcast.operators import gold as G
from shelfcast.operators import history as H
from shelfcast.operators import repeated as R
from shelfcast.operators import silver as S
from shelfcast.plans import catalog as CAT
from shelfcast.plans import jobs as JOBS
from shelfcast.schemas import KAFKA_ROW
from shelfcast.session import scratch_path
from shelfcast.sources import lakehouse as L
from shelfcast.sources import retail_view as RV
from shelfcast.streaming import current_state as STATE
from shelfcast.streaming import landing as LANDING
from tests.conftest import envelope, kafka_row, sale_payload
from tests.test_rows_that_come_once import lineitems

AS_OF, LATER = "2026-09-03 08:00:00", "2026-09-04 08:00:00"


def sale(offset, units):
    value = envelope("sales_transactions", "c", sale_payload(f"t{offset}", units), lsn=offset)
    return kafka_row(RV.topic_for("sales_transactions"), 0, offset, {"transaction_id": f"t{offset}"}, value)


def with_conf(spark, **conf):
    """Sets ``conf`` (dots as double underscores) and returns what puts it back."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.set(k, v) if v is not None else spark.conf.unset(k) for k, v in before.items()]


def data_files(path):
    return sum(f.startswith("part-") for _, _, names in os.walk(path) for f in names)


# ------------------------------------------------------------------- files


def test_a_value_has_few_files_where_parts_are_split(spark):
    """Parts of the deal were as few as the session's; split by size, each piece held a file of every value in it."""
    rows = spark.range(0, 40000, 1, 4).select((F.col("id") % 80).alias("day"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    path = scratch_path(spark, "test_fine_deal")
    back = with_conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="65536")
    try:
        L.write_lake_table(rows, path, "overwrite", ["day"], sort_within=["text"])
    finally:
        back()
    assert data_files(path) <= 2 * 80
    assert L.read_lake_table(spark, path).agg(F.count("text"), F.count_distinct("text"), F.count_distinct("day")).first() == (40000, 40000, 80)


# ------------------------------------------------------------------ copies


def test_marks_find_every_repeated_key_and_few_others(spark):
    rows = spark.range(6000).unionByName(spark.range(0, 6000, 3)).select(F.when(F.col("id") != 9, F.col("id")).alias("k"), "id")
    bitmaps = R.repeated_or_marked(rows, ["k"])
    once, again = (R.may_be_marked(rows, ["k"], bitmaps, m) for m in (False, True))
    assert again.where("id % 3 = 0").count() == 4000 and once.count() >= 3990 and once.count() + again.count() == 8000
    kept = R.keep_last_where_repeated(rows, ["k"], bitmaps, lambda some: some.groupBy("k").agg(F.max("id").alias("id")))
    assert sorted(r["id"] for r in kept.collect()) == list(range(6000))


def test_few_repeated_keys_are_listed_and_too_full_bitmaps_are_not_used(spark, monkeypatch):
    rows = spark.range(3000).unionByName(spark.range(2000))
    assert R.repeated_or_marked(spark.range(10), ["id"]) == []
    assert len(R.repeated_or_marked(spark.range(10).unionByName(spark.range(2)), ["id"])) == 2
    monkeypatch.setattr(R, "MARK_BITS", 1 << 11)
    assert R.repeated_or_marked(rows, ["id"]) is None


def test_rows_that_come_once_are_not_grouped_where_many_repeat(spark, monkeypatch):
    """All rows were sorted and shuffled with their texts once more than a thousand keys repeated."""
    monkeypatch.setattr(R, "FEW_REPEATED", 1)
    both = B.bronze_rows(spark.createDataFrame([sale(i, i) for i in range(40)], KAFKA_ROW), AS_OF).unionByName(
        B.bronze_rows(spark.createDataFrame([sale(i, 1000 + i) for i in range(5)], KAFKA_ROW), LATER))
    want = [(i, 1000 + i if i < 5 else i) for i in range(40)]
    for kept in (S.silver_events(both, AS_OF), S.silver_events(B.dedup_landing(both), AS_OF)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "LeftSemi" in plan
        assert sorted((r["kafka_offset"], json.loads(r["record_data"])["units"]) for r in kept.collect()) == want


def history(spark, rows):
    schema = "source_table string, record_key string, event_at timestamp, source_lsn long, kafka_topic string, kafka_partition int, kafka_offset long, is_deleted boolean, record_data string"
    at = [datetime(2026, 1, 1 + d, tzinfo=UTC) for d in range(9)]
    return spark.createDataFrame([("stores", k, at[d], n, "t", 0, n, gone, f"{k}{n}") for n, (k, d, gone) in enumerate(rows)], schema)


def test_the_only_event_of_a_key_is_not_dealt_out(spark, monkeypatch):
    """Every event went through a window over its key and day, texts included."""
    alone = H.record_history(history(spark, [("a", 0, False), ("b", 1, True), ("c", 2, False)]))
    assert "Window" not in alone._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["record_key"], r["valid_to"]) for r in alone.collect()) == [("a", None), ("c", None)]
    mixed = [("a", 0, False), ("b", 1, False), ("a", 3, True), ("c", 2, False), ("b", 4, False), ("d", 5, True)]
    want = [("a", "a0", 4), ("b", "b1", 5), ("b", "b4", None), ("c", "c3", None)]
    for few in (1000, 1, 0):
        monkeypatch.setattr(R, "FEW_REPEATED", few)
        kept = H.record_history(history(spark, mixed)).select("record_key", "record_data", F.dayofmonth("valid_to").alias("to")).collect()
        assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_the_only_event_of_a_sale_is_not_dealt_out(spark, monkeypatch):
    def silver(rows):
        return S.silver_rows(B.bronze_rows(spark.createDataFrame(rows, KAFKA_ROW), AS_OF), AS_OF)

    once = silver([sale(i, i) for i in range(9)])
    assert "Exchange" not in G.live_sales(once, stored=True)._jdf.queryExecution().executedPlan().toString()
    later = [kafka_row(RV.topic_for("sales_transactions"), 0, 50 + i, {"transaction_id": f"t{i}"},
                       envelope("sales_transactions", "u", sale_payload(f"t{i}", 70 + i), ts_ms=1788237599999)) for i in range(4)]
    both = silver([sale(i, i) for i in range(9)] + later)
    for few in (1000, 1):
        monkeypatch.setattr(R, "FEW_REPEATED", few)
        live = [sorted(map(tuple, G.live_sales(both, stored=s).collect())) for s in (False, True)]
        assert live[0] == live[1] and len(live[0]) == 9
        assert sorted(json.loads(r[-1])["units"] for r in live[0]) == [4, 5, 6, 7, 8, 70, 71, 72, 73]


def test_the_order_is_carried_once(spark):
    events = history(spark, [("a", 0, False), ("a", 3, True), ("b", 1, False)]).select("record_key", *G.EVENT_ORDER_COLUMNS, "is_deleted", "record_data")
    kept = G.latest_per_key(events, "record_key", [*G.EVENT_ORDER_COLUMNS, "is_deleted", "record_data"])
    assert kept._jdf.queryExecution().analyzed().toString().count("kafka_offset") < 8
    assert kept.columns == events.columns and sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in events.where("record_data != 'a0'").collect())


def test_stored_silver_makes_the_messages_once(spark, tmp_path):
    d = lineitems(spark, tmp_path)
    silver = CAT.stored_silver(spark, d)
    assert "parquet" in silver._jdf.queryExecution().optimizedPlan().toString().lower() and "lineitem" not in silver.inputFiles()[0]
    want = CAT.silver_table(spark, d).select(*silver.columns)
    assert sorted(map(str, silver.collect())) == sorted(map(str, want.collect()))


# ------------------------------------------------------------------ passes


def test_a_log_of_some_tables_is_that_part_of_the_whole_log(spark, tmp_path):
    """The stores' and products' messages were picked out of a log with every sale in it."""
    d = lineitems(spark, tmp_path)
    for tables in (["stores", "products"], ["promotions", "stores"]):
        part = RV.change_log(spark, d, redeliver=True, tables=tables)
        whole = RV.change_log(spark, d, redeliver=True).where(F.col("topic").isin([RV.topic_for(t) for t in tables]))
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect())) and part.count() > 0
    some = RV.change_log(spark, d, tables=["stores", "products"])
    assert not any("lineitem" in f for f in some.inputFiles()) and any("part.parquet" in f for f in some.inputFiles())


def test_a_batch_is_read_once_for_its_coordinates_and_once_to_be_written(spark):
    """Each comparison read the whole batch again: its ranges, what is stored, what is repeated."""
    path = scratch_path(spark, "test_passes")
    JOBS.land_bronze_batch(spark.createDataFrame([sale(i, i) for i in range(0, 40, 2)], KAFKA_ROW), path, AS_OF)
    reads = spark.sparkContext.accumulator(0)

    def seen(row):
        reads.add(1)
        return row

    batch = spark.createDataFrame(spark.sparkContext.parallelize([sale(i, i) for i in range(1, 40, 2)], 2).map(seen), KAFKA_ROW, verifySchema=False)
    with JOBS.rows_to_land(B.bronze_rows(batch, AS_OF), path) as rows:
        assert JOBS.write_bronze(rows, path, "append") == 20
    assert reads.value == 40
    assert sorted(r[0] for r in L.read_lake_table(spark, path).select("kafka_offset").collect()) == list(range(40))


@pytest.mark.parametrize("few", [1000, 1])
def test_a_batch_lands_what_is_neither_stored_nor_repeated(spark, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_REPEATED", few)
    path = scratch_path(spark, "test_to_land")
    sink = LANDING.bronze_sink(path)
    landed = [sink(spark.createDataFrame([sale(i, i) for i in part], KAFKA_ROW), n) for n, part in enumerate(
        [[*range(10), 3, 4, 5], [*range(5, 15), 12, 12, 13], [*range(15)], [*range(20, 23)], []])]
    assert landed == [10, 5, 0, 3, 0]
    assert sorted(r[0] for r in L.read_lake_table(spark, path).select("kafka_offset").collect()) == [*range(15), 20, 21, 22]


def test_a_message_is_parsed_once_for_its_latest_event(spark):
    messages = spark.createDataFrame([sale(i, i) for i in range(3)], KAFKA_ROW)
    latest = STATE.latest_events(messages)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("CollectMetrics"):]
    assert not any("Filter" in line and "parseJson" in line for line in below.splitlines())
    assert sorted(r[STATE.KEY] for r in latest.collect()) == ["t0", "t1", "t2"]


def test_the_watermark_query_keeps_its_state_on_disk(spark, tmp_path, monkeypatch):
    """All keys were held on the heap."""
    before, stores = spark.conf.get(LANDING.STATE_STORE, None), []
    plain = LANDING.state_on_disk
    monkeypatch.setattr(LANDING, "state_on_disk", lambda s: stores.append(s) or plain(s))
    rows = CAT.QUERIES["stream_watermark_dedup"](spark, lineitems(spark, tmp_path)).collect()
    assert len(stores) == 2 and len(rows) == len(set(rows)) > 0
    assert spark.conf.get(LANDING.STATE_STORE, None) == before
    with plain(spark):
        assert "RocksDB" in spark.conf.get(LANDING.STATE_STORE)


def test_rows_added_to_a_bucket_are_one_file(spark, monkeypatch):
    """Every task wrote a file for every bucket, batch after batch."""
    monkeypatch.setattr(STATE, "SMALL_BUCKET_BYTES", 0)
    root = scratch_path(spark, "test_added_files")
    for n, part in enumerate([range(40), range(20)]):
        rows = STATE.latest_events(spark.createDataFrame([sale(i, i) for i in part], KAFKA_ROW)).repartition(4)
        STATE.merge_events(rows, n, root, buckets=2)
    added = [p for paths in STATE.live_parts(spark, root).values() for p in paths[1:]]
    assert len(added) == 2 and [data_files(p) for p in added] == [1, 1]
    assert STATE.current_state(spark, root).count() == 40
