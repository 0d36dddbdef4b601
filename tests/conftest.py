from __future__ import annotations

import json
import os
import sys
from datetime import UTC, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="shelfcast-tests", shuffle_partitions=4)
    yield session
    session.stop()


def envelope(table: str, op: str, after: dict | None, before: dict | None = None, ts_ms: int | None = 1788237572650,
             source_ts_ms: int | None = 1788237572499, lsn: int | None = 12345, snapshot: str = "false") -> str:
    return json.dumps({
        "before": before,
        "after": after,
        "source": {"schema": "retail", "table": table, "lsn": lsn, "ts_ms": source_ts_ms, "snapshot": snapshot},
        "op": op,
        "ts_ms": ts_ms,
    })


def kafka_row(topic: str, partition: int, offset: int, key: dict | None, value: str | bytes | None,
              ts: datetime | None = None) -> tuple:
    raw_value = value.encode() if isinstance(value, str) else value
    return (
        json.dumps(key).encode() if key is not None else None,
        raw_value,
        topic,
        partition,
        offset,
        ts or datetime(2026, 9, 3, 8, 0, tzinfo=UTC),
        0,
    )


def sale_payload(txn: str, units: int, net: str = "8.00", store: str = "STORE-001", sku: str = "SKU-0001",
                 business_date: int = 20089, stockout: bool = False, promotion_id: str | None = None,
                 unit_price: str = "4.00", discount: str = "0.00", gross: str | None = None) -> dict:
    return {
        "transaction_id": txn,
        "store_id": store,
        "sku_id": sku,
        "business_date": business_date,
        "sale_ts": "2025-01-01T09:30:00Z",
        "units": units,
        "unit_price": unit_price,
        "discount_pct": discount,
        "gross_revenue": gross or net,
        "net_revenue": net,
        "inventory_on_hand": 10,
        "is_stockout": stockout,
        "promotion_id": promotion_id,
    }
