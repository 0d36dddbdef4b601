"""Exact rounding, run metadata, settings records, the idle stop and replay by offset ranges."""

from __future__ import annotations

import math
import random
import threading
import time
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast.config import ForecastSettings, GoldSettings, LandingSettings, SilverSettings, settings_from
from shelfcast.errors import BaselineForecastError
from shelfcast.functions.numbers import round_exact
from shelfcast.plans import jobs as JOBS
from shelfcast.plans.metadata import flatten_summary
from shelfcast.schemas import KAFKA_ROW
from shelfcast.session import scratch_path
from shelfcast.sources import lakehouse as L
from shelfcast.sources import retail_view as RV
from shelfcast.streaming import landing as STREAM
from tests.conftest import envelope, kafka_row, sale_payload

STORES = RV.topic_for("stores")
AS_OF = "2026-09-03 08:00:00"


def test_rounding_by_exact_value_equals_the_definition(spark):
    rng = random.Random(4)
    values = [2.00005, 0.12345, 1.00015, 0.03125, 0.09375, -0.03125, 0.00005, -0.00005, 0.0, 1e-320, 4.5e11 + 0.00006, 1e15 + 0.5, 1e300, -7.5, 33.33335]
    values += [k / 20000 for k in range(1, 400, 2)] + [k / 32 for k in range(-50, 50)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 13) for _ in range(3000)]
    values += [round(rng.uniform(0, 1000), 4) + 0.00005 for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 2, 4, 8):
        for x, got in df.select("x", round_exact(F.col("x"), digits)).collect():
            assert got == round(x, digits), (x, digits)
    odd = spark.createDataFrame([(None,), (math.nan,), (math.inf,)], "x double").select(round_exact(F.col("x"))).collect()
    assert odd[0][0] is None and math.isnan(odd[1][0]) and odd[2][0] == math.inf
    with pytest.raises(ValueError):
        round_exact(F.col("x"), 9)


def test_summary_flattening(spark):
    row = (3, True, 0.5, "run", None, None, {"b": 1}, (date(2025, 1, 2), None), [1, 2], date(2025, 1, 3), Decimal("1.50"), datetime(2026, 9, 3, 8, tzinfo=UTC), [])
    df = spark.createDataFrame([row], "rows long, ok boolean, share double, mode string, dir string, missing map<string,int>, counts map<string,int>, "
                                      "span struct<min: date, max: date>, `a.list` array<int>, day date, price decimal(5,2), at timestamp, none array<int>")
    got = {r["key"]: (r["kind"], r["value"]) for r in flatten_summary(df).collect()}
    assert got == {
        "rows": ("bigint", "3"), "ok": ("boolean", "true"), "share": ("double", "0.5"), "mode": ("string", "run"), "dir": ("none", "None"),
        "missing": ("none", "None"), "counts": ("json", '{"b":1}'), "span": ("json", '{"min":"2025-01-02","max":null}'), "a.list": ("json", "[1,2]"),
        "day": ("text", "2025-01-03"), "price": ("text", "1.50"), "at": ("text", "2026-09-03 08:00:00"), "none": ("json", "[]")}
    assert flatten_summary(df.where("rows < 0")).count() == 0


def test_settings_records_and_overrides():
    landing = settings_from(LandingSettings, {"X_BATCH_SIZE": "7", "X_MAX_MESSAGES": "9", "X_IDLE_TIMEOUT_SECONDS": "1.5", "X_MODE": ""}, "X_",
                            bronze_path="b", checkpoint="c")
    assert (landing.batch_size, landing.max_messages, landing.idle_timeout_seconds, landing.mode) == (7, 9, 1.5, "append")
    assert LandingSettings("b", "c").idle_timeout_seconds == 10.0
    assert settings_from(SilverSettings, {"MODE": "append"}, bronze_path="b", silver_path="s").mode == "append"
    forecast = settings_from(ForecastSettings, {"WRITE_OUTPUTS": "no", "HOLDOUT_DAYS": "14"}, gold_path="g", holdout_days=21)
    assert (forecast.holdout_days, forecast.season_length_days, forecast.write_outputs) == (21, 7, False)
    with pytest.raises(TypeError):
        settings_from(GoldSettings, {})


def test_jobs_run_from_settings(spark):
    root = scratch_path(spark, "test_settings")
    topic = RV.topic_for("sales_transactions")
    rows = [kafka_row(topic, 0, i, {"transaction_id": f"T{i}"}, envelope("sales_transactions", "c", sale_payload(f"T{i}", i + 1, business_date=20089 + i)))
            for i in range(20)]
    src = f"{root}/src"
    spark.createDataFrame(rows, KAFKA_ROW).coalesce(1).write.parquet(src)
    out = STREAM.land_with_settings(spark, LandingSettings(f"{root}/bronze", f"{root}/ckpt", source=src, idle_timeout_seconds=None))
    assert out["landed_rows"] == 20 and not out["stopped_idle"]
    JOBS.silver_with_settings(spark, SilverSettings(f"{root}/bronze", f"{root}/silver"), AS_OF)
    assert JOBS.gold_with_settings(spark, GoldSettings(f"{root}/silver", f"{root}/gold"), AS_OF)["gold_rows"] == 20
    quiet = JOBS.evaluate_with_settings(spark, ForecastSettings(f"{root}/gold", holdout_days=7, output_dir=f"{root}/out", write_outputs=False))
    assert quiet["forecast_rows"] == 7 and quiet["output_dir"] is None and not L.table_exists(spark, f"{root}/out")
    with pytest.raises(BaselineForecastError):
        JOBS.evaluate_with_settings(spark, ForecastSettings(f"{root}/nowhere"))


def test_drain_stops_once_the_source_is_quiet(spark):
    src, bronze = scratch_path(spark, "test_idle_src"), scratch_path(spark, "test_idle_bronze")

    def send(first: int) -> None:
        rows = [kafka_row(STORES, 0, first + i, None, envelope("stores", "r", {"i": i})) for i in range(5)]
        spark.createDataFrame(rows, KAFKA_ROW).coalesce(1).write.mode("append").parquet(src)

    send(0)
    out = {}
    drain = threading.Thread(target=lambda: out.update(STREAM.land_bronze_stream(
        spark, src, bronze, scratch_path(spark, "test_ckpt"), idle_timeout_seconds=6, poll_seconds=0.5)))
    drain.start()
    limit = time.monotonic() + 30
    while not L.table_exists(spark, f"{bronze}") and time.monotonic() < limit:
        time.sleep(0.1)
    send(10)  # arrives after the first batch was written
    drain.join(60)
    assert not drain.is_alive() and out["stopped_idle"] and not out["stopped_at_cap"]
    assert out["batches"] >= 2 and out["landed_rows"] == 10
    assert sorted(r[0] for r in L.read_lake_table(spark, bronze).select("kafka_offset").collect()) == [*range(5), *range(10, 15)]


def test_replay_reads_just_the_offset_ranges(spark):
    src = scratch_path(spark, "test_replay_src")
    rows = [kafka_row(STORES, p, i, None, envelope("stores", "r", {"i": i})) for p in (0, 1) for i in range(10)]
    spark.createDataFrame(rows, KAFKA_ROW).coalesce(1).write.parquet(src)
    batch = STREAM.read_change_batch(spark, src, {STORES: {0: (2, 4), 1: (9, 99)}, "other": {0: (0, 5)}})
    assert sorted((r["partition"], r["offset"]) for r in batch.collect()) == [(0, 2), (0, 3), (1, 9)]
    assert "PushedFilters: [" in (plan := batch._jdf.queryExecution().executedPlan().toString()) and "PushedFilters: []" not in plan
    assert STREAM.read_change_batch(spark, src, {}).count() == 0
