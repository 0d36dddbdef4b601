"""Demand drivers, the promotion interval join, streaming landing and the driver contract."""

from __future__ import annotations

import os
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfcast.errors import BronzeLandingError
from shelfcast.operators import drivers as D
from shelfcast.schemas import KAFKA_ROW
from shelfcast.session import scratch_path
from shelfcast.sources import lakehouse as L
from shelfcast.sources import retail_view as RV
from shelfcast.streaming import landing as STREAM
from tests.conftest import envelope, kafka_row

STORES = RV.topic_for("stores")


def test_saturday_beats_monday_and_promotions_lift(spark):
    df = spark.createDataFrame([(date(2025, 1, 6),), (date(2025, 1, 11),)], "business_date date")
    mult = dict(df.select("business_date", D.weekday_multiplier(F.col("business_date"))).collect())
    assert mult[date(2025, 1, 11)] > mult[date(2025, 1, 6)]
    lift = spark.range(1).select(D.promotion_lift(F.lit(0.20), F.lit(2.0), F.lit(True))).first()[0]
    assert lift > 1.5
    none = spark.range(1).select(D.promotion_lift(F.lit(None).cast("double"), F.lit(2.0), F.lit(None))).first()[0]
    assert none == 1.0


def test_calendar_features(spark):
    days = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 15),), (date(2025, 1, 4),)],
                                 "business_date date")
    rows = {r["business_date"]: r for r in D.calendar_features(days, F.lit(date(2025, 1, 1))).collect()}
    assert rows[date(2025, 1, 1)]["weekday"] == 2 and rows[date(2025, 1, 1)]["payday_multiplier"] == 1.08
    assert rows[date(2025, 1, 4)]["payday_multiplier"] == 1.0
    assert rows[date(2025, 1, 15)]["day_offset"] == 14


def test_active_promotion_inclusive_range_lowest_id_wins(spark):
    promos = spark.createDataFrame(
        [("P2", "K", "S", date(2025, 1, 1), date(2025, 1, 5), 0.1, False),
         ("P1", "K", "S", date(2025, 1, 3), date(2025, 1, 3), 0.2, True),
         ("P3", "K", "S", date(2025, 1, 9), date(2025, 1, 8), 0.3, True)],
        "promotion_id string, sku_id string, store_id string, start_date date, end_date date, "
        "discount_pct double, feature_display boolean",
    )
    days = spark.createDataFrame([("S", "K", date(2025, 1, 1) + timedelta(days=i)) for i in range(9)],
                                 "store_id string, sku_id string, business_date date")
    got = {r["business_date"].day: r["promotion_id"]
           for r in D.active_promotion(days, promos).collect()}
    assert got == {1: "P2", 2: "P2", 3: "P1", 4: "P2", 5: "P2", 6: None, 7: None, 8: None, 9: None}


def test_revenue_lines_round_half_up(spark):
    df = spark.createDataFrame([("T", 3, "1.25", "0.10")], "transaction_id string, units int, unit_price string, "
                                                           "discount_pct string")
    r = D.revenue_lines(df).first()
    assert str(r["effective_unit_price"]) == "1.13"
    assert str(r["gross_revenue"]) == "3.75" and str(r["net_revenue"]) == "3.39"


def test_stockout_flags(spark):
    df = spark.createDataFrame([("T1", 5, 3), ("T2", 2, 3)], "transaction_id string, units int, inventory_on_hand int")
    rows = {r["transaction_id"]: r for r in D.stockout_flags(df).collect()}
    assert rows["T1"]["observed_units"] == 3 and rows["T1"]["is_stockout"] is True
    assert rows["T2"]["observed_units"] == 2 and rows["T2"]["is_stockout"] is False


def _write_source(spark, batches):
    src = scratch_path(spark, "test_stream_src")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, KAFKA_ROW).coalesce(1).write.mode("append").parquet(src)
    return src


def test_stream_landing_overwrite_first_then_append_and_restart(spark):
    rows = [[kafka_row(STORES, 0, b * 10 + i, {"store_id": f"S{i}"}, envelope("stores", "r", {"i": i}))
             for i in range(5)] for b in range(3)]
    src = _write_source(spark, rows)
    bronze, ckpt = scratch_path(spark, "test_bronze"), scratch_path(spark, "test_ckpt")
    # stale data that the first (overwrite) batch must replace
    L.write_lake_table(spark.createDataFrame([], "ingest_id string, source_table string, ingest_date date"),
                       bronze, "overwrite")
    summary = STREAM.land_bronze_stream(spark, src, bronze, ckpt, mode="overwrite", max_per_trigger=1)
    assert summary["batches"] == 3
    assert L.read_lake_table(spark, bronze).count() == 15
    again = STREAM.land_bronze_stream(spark, src, bronze, ckpt, mode="overwrite", max_per_trigger=1)
    assert again["batches"] == 0
    assert L.read_lake_table(spark, bronze).count() == 15


def test_stream_landing_is_idempotent_over_redelivery(spark):
    first = [kafka_row(STORES, 0, i, None, envelope("stores", "r", {"i": i})) for i in range(4)]
    replay = first[:2] + first[:1]
    src = _write_source(spark, [first, replay])
    bronze = scratch_path(spark, "test_bronze")
    STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "test_ckpt"), max_per_trigger=1)
    assert L.read_lake_table(spark, bronze).select("ingest_id").distinct().count() == 4
    assert L.read_lake_table(spark, bronze).count() == 4


def test_staged_overwrite_of_a_table_read_by_the_same_plan(spark):
    path = scratch_path(spark, "test_self_overwrite")
    L.write_lake_table(spark.range(5), path, "overwrite")
    L.write_lake_table(L.read_lake_table(spark, path).withColumn("id", F.col("id") + 1), path, "overwrite")
    assert sorted(r[0] for r in L.read_lake_table(spark, path).collect()) == [1, 2, 3, 4, 5]


def test_driver_contract(spark):
    import __spark_entry__ as E

    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    # the training-data operators say themselves which of them SQL can express
    own = {q for q in qs if q != "pipeline" and not q.startswith("op") or q == "operation_mix"}
    assert own <= set(oracle)
    df = E.entry(spark)
    assert df.count() > 0
    assert {"store_id", "sku_id", "business_date", "units_sold"} <= set(df.columns)
    assert os.path.isdir("/root/testdata/sf0.001")


def test_stream_landing_stops_at_message_cap(spark):
    batches = [[kafka_row(STORES, 0, b * 10 + i, None, envelope("stores", "r", {"i": i})) for i in range(5)]
               for b in range(4)]
    src = _write_source(spark, batches)
    bronze, ckpt = scratch_path(spark, "test_bronze"), scratch_path(spark, "test_ckpt")
    out = STREAM.land_bronze_stream(spark, src, bronze, ckpt, max_per_trigger=1, max_messages=7)
    landed = L.read_lake_table(spark, bronze).count()
    assert 7 <= landed <= 10 and out["batches"] <= 2
    assert out["stopped_at_cap"] and out["landed_rows"] == landed
    # nothing was skipped: the next run resumes where the capped run stopped
    STREAM.land_bronze_stream(spark, src, bronze, ckpt, max_per_trigger=1)
    assert L.read_lake_table(spark, bronze).count() == 20


def test_evaluate_baseline_writes_outputs(spark):
    from shelfcast.plans import jobs as JOBS

    rows = [("S1", "K1", date(2025, 1, 1) + timedelta(days=i), float(i % 7 + 1)) for i in range(40)]
    gold = spark.createDataFrame(rows, "store_id string, sku_id string, business_date date, units_sold double")
    out_dir = scratch_path(spark, "test_eval")
    summary = JOBS.evaluate_baseline(gold, output_dir=out_dir)
    assert summary["metrics"]["rows"] == 28 and summary["metrics"]["mae"] == 0.0
    assert summary["date_range"]["test_start"] == date(2025, 1, 13)
    assert spark.read.option("header", True).csv(os.path.join(out_dir, "seasonal_naive_forecasts")).count() == 28
    metrics = spark.read.json(os.path.join(out_dir, "seasonal_naive_metrics")).first()
    assert metrics["rows"] == 28


def test_default_landing_keeps_rows_far_behind_the_newest(spark):
    days = [datetime(2026, 9, 3 + d, tzinfo=UTC) for d in (20, 10, 0, 25)]
    src = _write_source(spark, [[kafka_row(STORES, 0, b * 10 + i, None, envelope("stores", "r", {"i": i}), ts=day) for i in range(5)]
                                for b, day in enumerate(days)])
    bronze = scratch_path(spark, "test_bronze")
    out = STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "test_ckpt"), max_per_trigger=1)
    assert out["landed_rows"] == L.read_lake_table(spark, bronze).count() == 20
    assert not out["stopped_at_cap"] and len(out["topics"]) == 4


def test_each_overwrite_run_replaces_the_table(spark):
    src = _write_source(spark, [[kafka_row(STORES, 0, i, None, envelope("stores", "r", {"i": i})) for i in range(4)]])
    bronze, ckpt = scratch_path(spark, "test_bronze"), scratch_path(spark, "test_ckpt")
    STREAM.land_bronze_stream(spark, src, bronze, ckpt, mode="overwrite")
    spark.createDataFrame([kafka_row(STORES, 0, 50 + i, None, envelope("stores", "r", {"i": i})) for i in range(3)], KAFKA_ROW).coalesce(1).write.mode(
        "append").parquet(src)
    STREAM.land_bronze_stream(spark, src, bronze, ckpt, mode="overwrite")
    assert sorted(r[0] for r in L.read_lake_table(spark, bronze).select("kafka_offset").collect()) == [50, 51, 52]


def test_undecodable_bytes_stop_landing_before_anything_is_committed(spark):
    good = [kafka_row(STORES, 0, i, None, envelope("stores", "r", {"i": i})) for i in range(3)]
    src = _write_source(spark, [[*good, kafka_row(STORES, 0, 9, None, b"\xff\xfe{")]])
    bronze = scratch_path(spark, "test_bronze")
    with pytest.raises(BronzeLandingError):
        STREAM.land_bronze_stream(spark, src, bronze, scratch_path(spark, "test_ckpt"))
    assert not L.table_exists(spark, bronze)


def test_all_zero_holdout_writes_null_percentages(spark):
    from shelfcast.plans import jobs as JOBS

    rows = [("S1", "K1", date(2025, 1, 1) + timedelta(days=i), 1.0 if i < 12 else 0.0) for i in range(40)]
    gold = spark.createDataFrame(rows, "store_id string, sku_id string, business_date date, units_sold double")
    out = JOBS.evaluate_baseline(gold, output_dir=scratch_path(spark, "test_eval"))
    assert out["metrics"]["mape_positive_actual_pct"] is None and out["panel_rows"] == 40 and out["forecast_rows"] == 28
