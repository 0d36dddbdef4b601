"""Bronze landing, silver transform and gold aggregation on hand-built change events."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import bronze as B
from shelfcast.operators import gold as G
from shelfcast.operators import silver as S
from shelfcast.schemas import KAFKA_ROW
from shelfcast.sources import retail_view as RV
from tests.conftest import envelope, kafka_row, sale_payload

AS_OF = "2026-09-03 08:00:00"
SALES = RV.topic_for("sales_transactions")
STORES = RV.topic_for("stores")


def _kafka(spark, rows):
    return spark.createDataFrame(rows, KAFKA_ROW)


def _silver(spark, rows, ingested_at=AS_OF):
    return S.silver_events(B.bronze_rows(_kafka(spark, rows), ingested_at), AS_OF)


def test_topics_are_prefix_schema_table():
    assert RV.topic_for("stores") == "shop.retail.stores"
    assert RV.topic_for("sales_transactions", prefix="acme") == "acme.retail.sales_transactions"


def test_bronze_row_keeps_raw_text_and_lifts_metadata(spark):
    value = envelope("stores", "r", {"store_id": "STORE-001"}, snapshot="first")
    key = {"store_id": "STORE-001"}
    row = B.bronze_rows(_kafka(spark, [kafka_row(STORES, 0, 12, key, value)]), AS_OF).first()
    assert row["kafka_key"] == json.dumps(key)
    assert row["debezium_value"] == value
    assert row["event_ts_ms"] == 1788237572650
    assert row["source_lsn"] == 12345
    assert row["source_schema"] == "retail" and row["source_table"] == "stores" and row["operation"] == "r"
    assert row["ingest_date"] == date(2026, 9, 3)
    assert row["ingest_id"] == hashlib.sha256(f"{STORES}:0:12".encode()).hexdigest()


def test_ingest_id_is_stable_and_offset_dependent(spark):
    value = envelope("stores", "r", {"store_id": "S"})
    rows = [kafka_row(STORES, 0, 12, None, value), kafka_row(STORES, 0, 12, None, value),
            kafka_row(STORES, 0, 13, None, value)]
    ids = [r["ingest_id"] for r in B.bronze_rows(_kafka(spark, rows), AS_OF).orderBy("kafka_offset").collect()]
    assert ids[0] == ids[1] != ids[2]


def test_zero_envelope_ts_falls_back_to_source_ts(spark):
    value = envelope("stores", "r", {"store_id": "S"}, ts_ms=0, source_ts_ms=1700000000000)
    row = B.bronze_rows(_kafka(spark, [kafka_row(STORES, 0, 1, None, value)]), AS_OF).first()
    assert row["event_ts_ms"] == 1700000000000


def test_missing_or_bad_value_lands_with_null_metadata(spark):
    rows = [kafka_row(STORES, 0, 1, None, None), kafka_row(STORES, 0, 2, None, "not json")]
    out = B.bronze_rows(_kafka(spark, rows), AS_OF).orderBy("kafka_offset").collect()
    assert all(r["source_table"] is None and r["operation"] is None for r in out)
    assert out[1]["debezium_value"] == "not json"


def test_silver_types_common_metadata(spark):
    value = envelope("stores", "r", {"store_name": "Northeast 001", "store_id": "STORE-001"}, snapshot="first")
    row = _silver(spark, [kafka_row(STORES, 0, 12, {"store_id": "STORE-001"}, value)]).first()
    assert row["operation_name"] == "snapshot_read"
    assert row["is_snapshot"] is True and row["is_deleted"] is False
    assert row["event_at"] == datetime.fromtimestamp(1788237572650 / 1000, tz=UTC).replace(tzinfo=None)
    assert row["event_date"] == date(2026, 9, 1)
    assert row["record_key"] == '{"store_id":"STORE-001"}'
    assert row["record_data"] == '{"store_id":"STORE-001","store_name":"Northeast 001"}'
    assert row["before_data"] is None


def test_snapshot_markers(spark):
    rows = [kafka_row(STORES, 0, i, None, envelope("stores", "r", {"a": i}, snapshot=m))
            for i, m in enumerate(["true", "last", "false", "first_in_data_collection"])]
    flags = [r["is_snapshot"] for r in _silver(spark, rows).orderBy("kafka_offset").collect()]
    assert flags == [True, True, False, False]


def test_silver_keeps_last_copy_of_a_coordinate(spark):
    first = B.bronze_rows(_kafka(spark, [
        kafka_row(STORES, 0, 1, None, envelope("stores", "r", {"store_name": "Original"})),
        kafka_row(STORES, 0, 2, None, envelope("stores", "r", {"store_name": "Next"})),
    ]), AS_OF)
    later = B.bronze_rows(_kafka(spark, [
        kafka_row(STORES, 0, 1, None, envelope("stores", "r", {"store_name": "Replacement"})),
    ]), "2026-09-04 08:00:00")
    out = S.silver_events(first.unionByName(later), AS_OF).orderBy("kafka_offset").collect()
    assert [json.loads(r["record_data"])["store_name"] for r in out] == ["Replacement", "Next"]


def test_canonical_json_sorts_keys_and_is_compact(spark):
    from shelfcast.functions.json_fns import canonical_json

    df = spark.createDataFrame([('{"b": 1, "a": {"d": null, "c": [2, 1]}}',), ("null",), (None,)], "s string")
    out = [r[0] for r in df.select(canonical_json("s")).collect()]
    assert out == ['{"a":{"c":[2,1],"d":null},"b":1}', None, None]


def test_unknown_operation_raises_in_strict_mode(spark):
    value = envelope("stores", "x", {"a": 1})
    with pytest.raises(Exception, match="Unknown change operation"):
        _silver(spark, [kafka_row(STORES, 0, 1, None, value)]).collect()


def test_epoch_day_decodes_to_date(spark):
    from shelfcast.functions.dates import variant_date
    from shelfcast.functions.json_fns import parse

    df = spark.createDataFrame([('{"d": 20089}',), ('{"d": "2025-01-02"}',)], "s string")
    out = [r[0] for r in df.select(variant_date(parse("s"), "$.d")).collect()]
    assert out == [date(2025, 1, 1), date(2025, 1, 2)]


def _sale(offset, txn, op="c", minute=0, lsn=100, **payload):
    body = sale_payload(txn, **payload)
    ts = int(datetime(2026, 9, 1, 4, minute, tzinfo=UTC).timestamp() * 1000)
    value = envelope("sales_transactions", op, None if op == "d" else body, body if op == "d" else None,
                     ts_ms=ts, lsn=lsn)
    return kafka_row(SALES, 0, offset, {"transaction_id": txn}, value)


def test_latest_event_wins_and_deleted_key_disappears(spark):
    rows = [
        _sale(1, "txn-1", units=1, net="4.00"),
        _sale(2, "txn-1", op="u", minute=5, units=3, net="12.00"),
        _sale(3, "txn-2", units=2),
        _sale(4, "txn-2", op="d", minute=10, units=2),
    ]
    current = G.current_transactions(_silver(spark, rows)).collect()
    assert [(r["transaction_id"], r["units"]) for r in current] == [("txn-1", 3)]


def test_delete_with_key_only_before_is_handled(spark):
    ts = int(datetime(2026, 9, 1, 4, 9, tzinfo=UTC).timestamp() * 1000)
    delete = envelope("sales_transactions", "d", None, {"transaction_id": "txn-2"}, ts_ms=ts)
    rows = [_sale(1, "txn-2", units=2), kafka_row(SALES, 0, 2, {"transaction_id": "txn-2"}, delete)]
    assert G.current_transactions(_silver(spark, rows)).count() == 0


def test_null_lsn_wins_a_tie_on_event_time(spark):
    # the null-LSN event has the lower offset, so only the null-last rule can make it win
    rows = [_sale(1, "txn-1", units=9, lsn=None), _sale(2, "txn-1", op="u", units=1, lsn=500)]
    assert G.current_transactions(_silver(spark, rows)).first()["units"] == 9


def test_gold_daily_aggregate(spark):
    rows = [
        _sale(1, "txn-1", units=2, net="8.00", promotion_id="PROMO-1", stockout=True),
        _sale(2, "txn-2", units=4, net="16.00"),
    ]
    gold = G.gold_daily_demand(G.current_transactions(_silver(spark, rows)), AS_OF).collect()
    assert len(gold) == 1
    g = gold[0]
    assert (g["store_id"], g["sku_id"], g["business_date"]) == ("STORE-001", "SKU-0001", date(2025, 1, 1))
    assert g["units_sold"] == 6 and g["transaction_count"] == 2
    assert g["net_revenue"] == 24.0
    assert g["stockout_transaction_count"] == 1 and g["stockout_rate"] == 0.5
    assert g["promo_transaction_count"] == 1 and g["promo_units"] == 2
    assert g["source_event_count"] == 2
    assert g["avg_unit_price"] == 4.0


def test_gold_drops_rows_with_null_group_key(spark):
    rows = [_sale(1, "txn-1", units=2), _sale(2, "txn-2", units=4, store=None)]
    gold = G.gold_daily_demand(G.current_transactions(_silver(spark, rows)), AS_OF).collect()
    assert [(g["store_id"], g["units_sold"]) for g in gold] == [("STORE-001", 2)]


def test_no_sales_events_gives_empty_gold(spark):
    rows = [kafka_row(STORES, 0, 1, None, envelope("stores", "r", {"store_id": "S"}))]
    assert G.gold_daily_demand(G.current_transactions(_silver(spark, rows)), AS_OF).count() == 0


def test_latest_per_key_plan_has_partial_aggregation(spark):
    rows = [_sale(i, f"txn-{i % 3}", units=i) for i in range(1, 10)]
    plan = G.current_transactions(_silver(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert F is not None


def test_duplicate_json_keys_keep_the_last_value(spark):
    from shelfcast.functions.json_fns import canonical_json

    df = spark.createDataFrame([('{"a": 1, "a": 2}',)], "s string")
    assert df.select(canonical_json("s")).first()[0] == '{"a":2}'


def test_hot_key_resolves_through_partial_aggregation(spark):
    # one transaction holds 300 of 330 events, spread over 8 input partitions
    hot = [_sale(i, "txn-hot", op="c" if i == 0 else "u", minute=i % 60, lsn=i, units=i + 1) for i in range(300)]
    cold = [_sale(1000 + i, f"txn-{i}", units=1) for i in range(30)]
    kafka = _kafka(spark, hot + cold).repartition(8)
    current = G.current_transactions(S.silver_events(B.bronze_rows(kafka, AS_OF), AS_OF))
    rows = {r["transaction_id"]: r["units"] for r in current.collect()}
    assert len(rows) == 31
    # latest = greatest event time (minute 59), then greatest LSN among those: i = 299
    assert rows["txn-hot"] == 300


def test_date_decoding_decodes_only_fields_of_the_rows_table(spark):
    from shelfcast.plans.catalog import DATE_FIELDS, QUERIES

    plan = QUERIES["date_decoding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.split("\n") if "Generate explode" in line and "business_date" in line)
    assert generate.count("CASE WHEN (source_table") == len(DATE_FIELDS)
