from __future__ import annotations

from datetime import timedelta

import pytest

from shelfcast.errors import GoldTransformError
from shelfcast.plans import incremental as INC
from shelfcast.plans import jobs as JOBS
from shelfcast.schemas import GOLD, KAFKA_ROW
from shelfcast.sources import lakehouse as L
from tests.conftest import envelope, kafka_row, sale_payload

SALES = "shop.retail.sales_transactions"
AS_OF = "2026-01-01 06:00:00"


def message(offset, txn, op, units, day, ts_ms, **more):
    payload = sale_payload(txn, units, business_date=day) | more
    after, before = (None, payload) if op == "d" else (payload, None)
    return kafka_row(SALES, 0, offset, {"transaction_id": txn}, envelope("sales_transactions", op, after, before, ts_ms=ts_ms, lsn=offset))


class Lake:
    def __init__(self, spark, root):
        self.spark = spark
        self.bronze, self.silver, self.gold = (f"{root}/{p}" for p in ("bronze", "silver", "gold"))
        self.offset = 0

    def run(self, *messages):
        rows = [message(self.offset + i, *m) for i, m in enumerate(messages)]
        self.offset += len(rows)
        if rows:
            JOBS.land_bronze_batch(self.spark.createDataFrame(rows, KAFKA_ROW).coalesce(1), self.bronze, AS_OF)
        return INC.append_silver(self.spark, self.bronze, self.silver, AS_OF), INC.append_gold(self.spark, self.silver, self.gold, AS_OF)

    def days(self):
        rows = L.read_lake_table(self.spark, self.gold, schema=GOLD).collect()
        return {(r["business_date"].isoformat(), r["store_id"]): (r["units_sold"], r["transaction_count"]) for r in rows}

    def rebuilt(self):
        path = f"{self.gold}-full"
        JOBS.build_gold(self.spark, self.silver, path, AS_OF)
        rows = L.read_lake_table(self.spark, path, schema=GOLD)
        mine = L.read_lake_table(self.spark, self.gold, schema=GOLD).select(*rows.columns)
        return rows.exceptAll(mine).count() + mine.exceptAll(rows).count()


def test_appends_equal_a_full_rebuild(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    s1, g1 = lake.run(("a", "c", 2, 20089, 1000), ("b", "c", 3, 20089, 1000), ("c", "c", 4, 20090, 1000), ("d", "c", 5, 20091, 1000))
    assert (s1["appended_rows"], g1["changed_transactions"], len(g1["touched_dates"])) == (4, 4, 3)
    # a moves to another date, d is deleted (its date empties), e is new
    s2, g2 = lake.run(("a", "u", 7, 20090, 2000), ("d", "d", 5, 20091, 2000), ("e", "c", 1, 20095, 2000))
    assert (s2["appended_rows"], g2["changed_transactions"]) == (3, 3)
    assert [d.isoformat() for d in g2["touched_dates"]] == ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-07"]
    assert [d.isoformat() for d in g2["gone_dates"]] == ["2025-01-03"]
    assert lake.days() == {("2025-01-01", "STORE-001"): (3, 1), ("2025-01-02", "STORE-001"): (11, 2), ("2025-01-07", "STORE-001"): (1, 1)}
    assert lake.rebuilt() == 0
    # an older version of a arrives late: nothing changes; nothing new: nothing is touched
    _, g3 = lake.run(("a", "u", 50, 20089, 1500))
    assert lake.days()["2025-01-02", "STORE-001"] == (11, 2) and lake.rebuilt() == 0
    s4, _ = lake.run()
    assert s4["appended_rows"] == 0 and lake.rebuilt() == 0


def test_a_small_append_reads_the_new_files_only(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    for day in range(4):
        lake.run(*[(f"t{day}-{i}", "c", 1, 20089 + 10 * day + i, 1000 + day * 86_400_000) for i in range(6)])
    all_files = len(L.read_lake_table(spark, lake.silver).inputFiles())
    JOBS.land_bronze_batch(spark.createDataFrame([message(100, "t0-0", "u", 9, 20089, 900_000_000)], KAFKA_ROW), lake.bronze, AS_OF)
    fresh, _ = INC.files_since_mark(spark, lake.bronze, INC.BRONZE, lake.silver, timedelta(0))
    assert len(fresh.inputFiles()) == 1 < len(L.read_lake_table(spark, lake.bronze).inputFiles())
    INC.append_silver(spark, lake.bronze, lake.silver, AS_OF, timedelta(0))
    fresh, _ = INC.files_since_mark(spark, lake.silver, INC.SILVER, lake.gold, timedelta(0))
    assert len(fresh.inputFiles()) == 1 < all_files
    wide, _ = INC.files_since_mark(spark, lake.silver, INC.SILVER, lake.gold)
    assert len(wide.inputFiles()) == all_files + 1
    before = set(L.read_lake_table(spark, lake.gold, schema=GOLD).inputFiles())
    out = INC.append_gold(spark, lake.silver, lake.gold, AS_OF)
    kept = [p for p in L.read_lake_table(spark, lake.gold, schema=GOLD).inputFiles() if p in before]
    assert len(out["touched_dates"]) == 1 and len(kept) == len(before) - 1
    assert lake.rebuilt() == 0


def test_a_failed_run_is_repeated(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path)
    lake.run(("a", "c", 2, 20089, 1000), ("b", "c", 3, 20090, 1000))
    real = L.drop_partitions

    def lost(*args):
        raise OSError("driver lost")

    monkeypatch.setattr(L, "drop_partitions", lost)
    with pytest.raises(OSError):
        lake.run(("a", "u", 7, 20090, 2000))
    monkeypatch.setattr(L, "drop_partitions", real)
    _, again = lake.run()
    assert again["changed_transactions"] == 1 and [d.isoformat() for d in again["gone_dates"]] == ["2025-01-01"]
    assert lake.days() == {("2025-01-02", "STORE-001"): (10, 2)} and lake.rebuilt() == 0


def test_unusable_payload_stops_before_writing(spark, tmp_path):
    lake = Lake(spark, tmp_path)
    lake.run(("a", "c", 2, 20089, 1000))
    with pytest.raises(GoldTransformError, match="units"):
        lake.run(("b", "c", "many", 20089, 1000))
    assert lake.days() == {("2025-01-01", "STORE-001"): (2, 1)}
