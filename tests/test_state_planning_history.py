from __future__ import annotations

import json
import math
import random
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal
from urllib.parse import unquote

import pytest

from shelfcast.errors import BaselineForecastError
from shelfcast.operators import forecast as FC
from shelfcast.operators import history as H
from shelfcast.operators import planning as P
from shelfcast.schemas import KAFKA_ROW, SILVER
from shelfcast.sources import lakehouse as L
from shelfcast.streaming import current_state as STATE
from shelfcast.streaming import daily_demand as DAILY
from tests.conftest import envelope, kafka_row, sale_payload

SALES = "shop.retail.sales_transactions"


def message(offset, txn, op, units, ts_ms):
    payload = sale_payload(txn, units)
    after, before = (None, payload) if op == "d" else (payload, None)
    return kafka_row(SALES, 0, offset, {"transaction_id": txn}, envelope("sales_transactions", op, after, before, ts_ms=ts_ms, lsn=offset))


# ---------------------------------------------------------------- T5


def write_wave(spark, path, rows):
    spark.createDataFrame(rows, KAFKA_ROW).coalesce(1).write.mode("append").parquet(path)


def units(spark, root):
    return {r["transaction_id"]: r["units"] for r in STATE.current_transactions(spark, root).collect()}


def test_state_follows_updates_deletes_and_late_events(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / p) for p in ("src", "state", "ckpt"))
    write_wave(spark, src, [message(1, "a", "c", 1, 1000), message(2, "b", "c", 5, 1000), message(3, "c", "c", 7, 1000)])
    first = STATE.maintain_current_state(spark, src, root, ckpt, buckets=8)
    assert units(spark, root) == {"a": 1, "b": 5, "c": 7} and len(first["batches"]) == 1
    # an update, a delete, and an event older than what is stored
    write_wave(spark, src, [message(6, "a", "u", 3, 5000), message(7, "b", "d", 5, 6000), message(0, "c", "u", 99, 500)])
    STATE.maintain_current_state(spark, src, root, ckpt, buckets=8)
    assert units(spark, root) == {"a": 3, "c": 7}
    # the deleted key's older update arrives late: its tombstone wins
    write_wave(spark, src, [message(5, "b", "u", 6, 5500), message(6, "a", "u", 3, 5000)])
    STATE.maintain_current_state(spark, src, root, ckpt, buckets=8)
    assert units(spark, root) == {"a": 3, "c": 7}
    assert {r["transaction_key"]: r["is_deleted"] for r in STATE.current_state(spark, root).collect()} == {"a": False, "b": True, "c": False}


def test_only_touched_buckets_are_written_and_half_batches_are_not_read(spark, tmp_path):
    root = str(tmp_path / "state")
    many = spark.createDataFrame([message(i, f"t{i}", "c", 1, 1000) for i in range(200)], KAFKA_ROW)
    assert len(STATE.merge_batch(many, 0, root, buckets=16)) == 16
    one = spark.createDataFrame([message(900, "t7", "u", 2, 2000)], KAFKA_ROW)
    touched = STATE.merge_batch(one, 1, root, buckets=16)
    assert len(touched) == 1 and L.list_folders(spark, f"{root}/batch=1") == [f"bucket={touched[0]}"]
    # a batch without its marker was cut off: readers keep the version before, and running it again is enough
    L.discard(spark, f"{root}/batch=1/_SUCCESS")
    assert units(spark, root)["t7"] == 1
    STATE.merge_batch(one, 1, root, buckets=16)
    STATE.merge_batch(one, 1, root, buckets=16)
    assert units(spark, root)["t7"] == 2 and len(units(spark, root)) == 200
    STATE.drop_superseded(spark, root, 2)
    assert len(L.list_folders(spark, f"{root}/batch=0")) == 15 and len(units(spark, root)) == 200


def test_empty_state_and_empty_batch(spark, tmp_path):
    root = str(tmp_path / "state")
    assert STATE.current_transactions(spark, root).count() == 0
    assert STATE.merge_batch(spark.createDataFrame([], KAFKA_ROW), 0, root) == []


def test_large_buckets_take_rows_beside_them_until_these_outgrow_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(STATE, "SMALL_BUCKET_BYTES", 0)
    root = str(tmp_path / "state")
    batches = [[message(i, f"t{i}", "c", 1, 1000) for i in range(400)], [message(900, "t7", "u", 2, 2000), message(901, "t8", "d", 1, 2000)],
               [message(902, "t7", "u", 3, 1500), message(903, "new", "c", 4, 1000)]]
    batches.append([message(1000 + i, f"t{i}", "u", 5, 3000) for i in range(0, 400, 2)])
    written = []
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, KAFKA_ROW)
        for _ in range(2):  # run again: the batch's own folder is replaced
            STATE.merge_batch(frame, n, root, buckets=2)
        STATE.drop_superseded(spark, root, n)
        written.append(L.list_folders(spark, f"{root}/batch={n}"))
        if n == 1:  # added, the older rows stay where they are; a batch cut off is not read
            assert len(L.list_folders(spark, f"{root}/batch=0")) == 2
            assert units(spark, root)["t7"] == 2 and "t8" not in units(spark, root)
    assert written[0] == ["bucket=0", "bucket=1"] and all(unquote(f).endswith("+") for f in written[1] + written[2])
    want = {f"t{i}": 5 if i % 2 == 0 else 1 for i in range(400)} | {"t7": 2, "new": 4}
    assert units(spark, root) == want
    assert STATE.current_state(spark, root).count() == 401
    for n in range(4, 8):  # the same rows again and again: both buckets are written whole once more
        STATE.merge_batch(spark.createDataFrame(batches[3], KAFKA_ROW), n, root, buckets=2)
        STATE.drop_superseded(spark, root, n + 1)
        written.append(L.list_folders(spark, f"{root}/batch={n}"))
    assert {"bucket=0", "bucket=1"} <= {f for folders in written[3:] for f in folders}
    assert L.list_folders(spark, f"{root}/batch=0") == [] and units(spark, root) == want


# ---------------------------------------------------------------- E5


def sale(i, day, hour, n, store="s1"):
    return (f"t{i}", store, "k1", datetime(2025, 1, day, hour, tzinfo=UTC), n)


def test_days_close_by_watermark_and_late_sales_are_listed(spark, tmp_path):
    src, closed, late, ckpt = (str(tmp_path / p) for p in ("src", "closed", "late", "ckpt"))

    def arrive(rows):
        spark.createDataFrame(rows, DAILY.SALES_SCHEMA).repartition(2).write.mode("append").parquet(src)
        return DAILY.drain_daily_demand(spark, src, closed, late, ckpt, delay="1 day")

    def days():
        return {(r["store_id"], r["business_date"].day): (r["units_sold"], r["sales"]) for r in DAILY.closed_days(spark, closed).collect()}

    assert arrive([sale(1, 1, 9, 2), sale(2, 1, 10, 3), sale(3, 3, 9, 1)])["late_rows"] == 0
    assert days() == {("s1", 1): (5, 2)}  # watermark: 2 January 09:00
    out = arrive([sale(4, 1, 8, 50), sale(5, 2, 8, 4), sale(6, 2, 9, 1, "s2"), sale(7, 6, 0, 1), ("t0", "s1", "k1", None, 9)])
    assert out["late_rows"] == 1 and out["watermark_ms"] == int(datetime(2025, 1, 5, tzinfo=UTC).timestamp() * 1000)
    assert days() == {("s1", 1): (5, 2), ("s1", 2): (4, 1), ("s2", 2): (1, 1), ("s1", 3): (1, 1)}
    assert [r["transaction_id"] for r in DAILY.late_sales(spark, late).collect()] == ["t4"]
    # nothing new: nothing changes
    assert DAILY.drain_daily_demand(spark, src, closed, late, ckpt, delay="1 day")["late_rows"] == 0 and len(days()) == 4


# ---------------------------------------------------------------- E1, E2, E3


def panel_rows(seed, series=4, length=70):
    rng = random.Random(seed)
    start = date(2025, 1, 1)
    return start, [(f"s{k}", f"k{k % 2}", start + timedelta(days=i), float(rng.choice([0, 0, 1, 2, 5, 9]))) for k in range(series) for i in range(length)]


PANEL = "store_id string, sku_id string, business_date date, units_sold double"


def naive(values, cutoff_index, i):
    return values[i - 7 * math.ceil((i - cutoff_index) / 7)]


def test_conformal_band_equals_sorted_residuals(spark):
    start, rows = panel_rows(1)
    panel = spark.createDataFrame(rows, PANEL)
    t0, t1 = start + timedelta(days=56), start + timedelta(days=69)
    got = {(r["store_id"], r["business_date"]): r for r in P.conformal_intervals(panel, t0, t1, calibration_days=28, alpha=Decimal("0.2")).collect()}
    for store in {r[0] for r in rows}:
        values = [r[3] for r in rows if r[0] == store]
        misses = sorted(abs(values[i] - naive(values, 27, i)) for i in range(28, 56))
        radius = misses[math.ceil(29 * 8 / 10) - 1]
        for i in range(56, 70):
            row, f = got[store, start + timedelta(days=i)], naive(values, 55, i)
            assert (row["radius"], row["forecast_units"]) == (radius, f)
            assert (row["lower_units"], row["upper_units"]) == (max(0.0, f - radius), f + radius)
            assert row["covered"] == (row["lower_units"] <= values[i] <= row["upper_units"])
    assert len(got) == 4 * 14


def test_conformal_needs_enough_residuals(spark):
    few = spark.createDataFrame([("s", "k", float(i)) for i in range(8)], "store_id string, sku_id string, absolute_error double")
    assert P.conformal_radius(few, Decimal("0.1")).first()["radius"] is None  # rank 9 of 8
    assert P.conformal_radius(few, Decimal("0.2")).first()["radius"] == 7.0  # rank ceil(7.2)
    with pytest.raises(BaselineForecastError):
        P.conformal_radius(few, Decimal("1"))
    wide = spark.createDataFrame([("s", "k", None, None, None, None)], "store_id string, sku_id string, radius double, lower_units double, "
                                 "upper_units double, covered boolean")
    assert P.coverage(wide).first().asDict() == {"rows": 0, "covered_rows": 0, "coverage": None, "target_coverage": 0.9, "mean_width": None}


def products(spark, rows):
    return spark.createDataFrame([(s, None if p is None else Decimal(p), None if c is None else Decimal(c)) for s, p, c in rows],
                                 "sku_id string, unit_price decimal(10,2), unit_cost decimal(10,2)")


def quantile(values, price, cost):
    """Smallest value whose empirical share reaches (price - cost) / price."""
    values = sorted(values)
    return next(v for i, v in enumerate(values, 1) if i * price >= len(values) * (price - cost))


def test_newsvendor_equals_sorted_demand(spark):
    start, rows = panel_rows(2, series=6)
    sold = spark.createDataFrame([r for r in rows if r[3]], PANEL)
    priced = products(spark, [("k0", "10.00", "3.00"), ("k1", "4.00", "4.50"), ("k9", "1.00", "0.10")])
    got = {r["store_id"]: r["order_units"] for r in P.newsvendor(sold, priced, (start, start + timedelta(days=69))).collect()}
    for store, sku in {(r[0], r[1]) for r in rows}:
        values = [r[3] for r in rows if r[0] == store]
        assert got[store] == (quantile(values, Decimal(10), Decimal(3)) if sku == "k0" else min(values))


def test_newsvendor_over_weeks(spark):
    start, rows = panel_rows(5, series=6, length=73)
    sold = spark.createDataFrame([r for r in rows if r[3]], PANEL)
    priced = products(spark, [("k0", "10.00", "3.00"), ("k1", "9.00", "6.50")])
    got = {r["store_id"]: r["order_units"] for r in P.newsvendor(sold, priced, (start, start + timedelta(days=72)), period=7).collect()}
    for store, sku in {(r[0], r[1]) for r in rows}:
        values = [r[3] for r in rows if r[0] == store][3:]  # 73 days: three before the first whole week
        weeks = [sum(values[i:i + 7]) for i in range(0, 70, 7)]
        price, cost = (Decimal(10), Decimal(3)) if sku == "k0" else (Decimal(9), Decimal("6.5"))
        assert got[store] == quantile(weeks, price, cost)


def test_newsvendor_without_price(spark):
    sold = spark.createDataFrame([("s", k, date(2025, 1, 1), 3.0) for k in ("none", "free", "unknown")], PANEL)
    out = P.newsvendor(sold, products(spark, [("none", None, "1.00"), ("free", "0.00", "0.00")]), (date(2025, 1, 1), date(2025, 1, 2)))
    assert {r["sku_id"]: r["order_units"] for r in out.collect()} == {"none": None, "free": None, "unknown": None}


def test_backtest_equals_day_by_day(spark):
    start, rows = panel_rows(3, series=3, length=60)
    rows = [r for r in rows if r[0] != "s2" or r[2] > start + timedelta(days=50)]  # a series without history
    bounds = (start, start + timedelta(days=59))
    priced = products(spark, [("k0", "10.00", "3.00"), ("k1", "8.00", "2.00")])
    cutoffs = P.rolling_cutoffs(bounds, folds=2, horizon=14)
    gold = spark.createDataFrame([r for r in rows if r[3]], PANEL)
    got = {(r["policy"], r["cutoff_date"]): r for r in P.policy_cost(P.rolling_orders(gold, priced, bounds, cutoffs, horizon=14), priced).collect()}
    price = {"k0": (Decimal(10), Decimal(3)), "k1": (Decimal(8), Decimal(2))}
    for cutoff in cutoffs:
        c = (cutoff - start).days
        cost = {"seasonal_naive": [Decimal(0), Decimal(0)], "newsvendor": [Decimal(0), Decimal(0)]}
        for store, sku in {(r[0], r[1]) for r in rows if r[3]}:
            values = [0.0] * 60
            for r in rows:
                if r[0] == store:
                    values[(r[2] - start).days] = r[3]
            p, k = price[sku]
            planned = quantile(values[:c + 1], p, k) if any(values[:c + 1]) else 0.0
            for i in range(c + 1, c + 15):
                for policy, order in (("seasonal_naive", naive(values, c, i)), ("newsvendor", planned)):
                    cost[policy][0] += Decimal(max(values[i] - order, 0)) * (p - k)
                    cost[policy][1] += Decimal(max(order - values[i], 0)) * k
        for policy, (under, over) in cost.items():
            row = got[policy, cutoff]
            assert (row["understock_cost"], row["overstock_cost"], row["total_cost"]) == (float(under), float(over), float(under) + float(over))
            assert row["orders"] == 14 * len({r[0] for r in rows if r[3]}) and row["unpriced_orders"] == 0
    with pytest.raises(BaselineForecastError):
        P.rolling_cutoffs(bounds, folds=5, horizon=14)


# ---------------------------------------------------------------- E6, E4


def event(i, key, at, data, deleted=False, table="stores", lsn=None):
    row = dict.fromkeys(f.name for f in SILVER.fields)
    row |= {"event_id": str(i), "record_key": key, "source_table": table, "event_at": at, "is_deleted": deleted, "source_lsn": lsn,
            "kafka_topic": "t", "kafka_partition": 0, "kafka_offset": i, "record_data": data}
    return tuple(row[f.name] for f in SILVER.fields)


def at(day, hour=0):
    return datetime(2025, 1, day, hour, tzinfo=UTC)


def test_history_equals_sorted_chains(spark):
    rng = random.Random(4)
    events = []
    for i in range(400):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(8)}"
        events.append((i, key, at(1 + rng.randrange(20), rng.randrange(24)), f"v{i}", rng.random() < 0.1, rng.choice([None, 1, 2])))
    df = spark.createDataFrame([event(i, k, t, d, x, lsn=n) for i, k, t, d, x, n in events] + [event(999, None, at(1), "x"), event(998, "n", None, "x")], SILVER)
    expected = set()
    for key in {e[1] for e in events}:
        chain = sorted((e for e in events if e[1] == key), key=lambda e: (e[2], e[5] is None, e[5] or 0, e[0]))
        for e, following in zip(chain, [*chain[1:], None], strict=True):
            end = following[2] if following else None
            if not e[4] and (end is None or end > e[2]):
                expected.add((key, e[2], end, e[3]))
    got = [(r["record_key"], r["valid_from"].replace(tzinfo=UTC), r["valid_to"] and r["valid_to"].replace(tzinfo=UTC), r["record_data"])
           for r in H.record_history(df).collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_gold_as_of_day(spark):
    def store(region):
        return json.dumps({"store_id": "s1", "region": region, "store_format": "corner"})

    silver = spark.createDataFrame([
        event(1, '{"store_id":"s1"}', at(3, 12), store("north")), event(2, '{"store_id":"s1"}', at(5), store("south")),
        event(3, '{"store_id":"s1"}', at(8, 1), store("south"), True),
        event(4, '{"sku_id":"k1"}', at(1), json.dumps({"category": "tea", "unit_price": "2.50"}), table="products"),
        event(5, '{"sku_id":"k1"}', datetime(2025, 3, 1, tzinfo=UTC), json.dumps({"category": "tea", "unit_price": "3.00"}), table="products")], SILVER)
    days = [date(2025, 1, d) for d in (1, 2, 3, 4, 5, 7, 8, 9)] + [date(2025, 2, 28), date(2025, 3, 1)]
    gold = spark.createDataFrame([("s1", "k1", d, 1) for d in days] + [("s9", "k9", days[0], 1)],
                                 "store_id string, sku_id string, business_date date, units_sold long")
    out = {(r["store_id"], r["business_date"]): (r["region"], r["category"], r["list_price"] and str(r["list_price"]))
           for r in H.enriched_gold(gold, H.record_history(silver)).collect()}
    regions = [None, None, "north", "north", "south", "south", None, None, None, None]
    assert out == {("s1", d): (x, "tea", "3.00" if d >= date(2025, 3, 1) else "2.50") for d, x in zip(days, regions, strict=True)} | {
        ("s9", days[0]): (None, None, None)}


def test_forecast_messages_are_raised():
    with pytest.raises(BaselineForecastError):
        FC.validate_evaluation_window(None, 0)
