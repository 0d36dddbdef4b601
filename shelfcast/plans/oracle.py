"""DuckDB SQL oracles: every checked query re-derived straight from the base tables.

The SQL restates the retail-view rules of ``shelfcast.sources.retail_view`` in
plain SQL (no JSON parsing, no Spark code path), so a match checks the whole
envelope -> bronze -> silver -> gold chain against an independent formulation.
Views available to the SQL: the driver's test tables.
"""

from __future__ import annotations

from shelfcast.operators import quality as Q
from shelfcast.schemas import PRIMARY_KEYS, RETAIL_TABLE_SCHEMAS

TOPIC_PREFIX = "shop"
KAFKA_PARTITIONS = 4
AS_OF = "2026-01-01 06:00:00"
REDELIVERY_LANDED_AT = "2026-01-02 06:00:00"
SNAPSHOT_AT = "1995-01-01 00:00:00"


def topic(table: str) -> str:
    return f"{TOPIC_PREFIX}.retail.{table}"


# ------------------------------------------------------------- shared CTEs

BASE = f"""
sales_ev0 AS (
  SELECT
    l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_shipdate,
    l.l_returnflag, l.l_linestatus, l.l_discount,
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
    printf('store-%02d', c.c_nationkey) AS store_id,
    p.p_type AS sku_id,
    CAST(l.l_shipdate AS DATE) AS business_date,
    l.l_shipdate + to_hours(CAST(8 + l.l_linenumber AS BIGINT)) AS sale_ts,
    CAST(l.l_quantity AS INTEGER) AS units,
    CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
    CAST(l.l_discount AS DECIMAL(5,2)) AS discount_pct,
    CAST(l.l_extendedprice AS DECIMAL(12,2)) AS gross_revenue,
    CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(5,2))) AS DECIMAL(12,2))
      AS net_revenue,
    CAST(p.p_size AS INTEGER) AS inventory_on_hand,
    l.l_returnflag = 'R' AS is_stockout,
    (l.l_discount >= 0.095 AND l.l_quantity >= 45) AS is_promo_row,
    (l.l_returnflag = 'A' AND l.l_linestatus = 'F') AS is_redelivered,
    CASE WHEN l.l_discount >= 0.095 AND l.l_quantity >= 45
         THEN printf('promo-%d-%d-%d', l.l_orderkey, l.l_linenumber, l.l_partkey) END AS promotion_id,
    CAST(row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber
                       ORDER BY l.l_shipdate, l.l_partkey, l.l_suppkey, l.l_quantity) - 1 AS INTEGER) AS version
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
sales_ev AS (
  SELECT *,
    CASE WHEN version = 0 THEN 'c'
         WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'd'
         ELSE 'u' END AS operation,
    epoch_ms(sale_ts) + version * 1000 AS event_ts_ms,
    CAST(l_orderkey % {KAFKA_PARTITIONS} AS INTEGER) AS kafka_partition,
    ((CAST(l_orderkey AS BIGINT) // {KAFKA_PARTITIONS}) * 1024 + l_linenumber - 1) * 1048576 + version AS kafka_offset
  FROM sales_ev0
),
current_tx AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY version DESC) AS _rn FROM sales_ev
  ) WHERE _rn = 1 AND operation <> 'd'
),
stores_t AS (
  SELECT printf('store-%02d', n.n_nationkey) AS store_id, n.n_name AS store_name, r.r_name AS region,
    ['corner', 'market', 'superstore', 'warehouse'][n.n_nationkey % 4 + 1] AS store_format,
    CAST([9000, 22000, 52000, 80000][n.n_nationkey % 4 + 1] AS INTEGER) AS square_feet,
    CAST(DATE '2015-01-01' + CAST(n.n_nationkey * 37 AS INTEGER) AS DATE) AS opened_on,
    CAST(['0.80', '1.00', '1.30', '1.60'][n.n_nationkey % 4 + 1] AS DECIMAL(8,4)) AS demand_multiplier,
    CAST(n.n_nationkey AS BIGINT) AS kafka_offset
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
products_t AS (
  SELECT p_type AS sku_id,
    upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS product_name,
    lower(p_type) AS category,
    min(p_brand) AS brand,
    CAST(floor(min(p_retailprice) * 0.6) AS DECIMAL(10,2)) AS unit_cost,
    CAST(max(p_retailprice) AS DECIMAL(10,2)) AS unit_price,
    CAST(min(p_size) + 7 AS INTEGER) AS shelf_life_days,
    CAST(max(p_size) AS DECIMAL(10,3)) AS base_daily_demand,
    CAST((min(p_partkey) % 20) / 100 AS DECIMAL(6,3)) AS seasonality_strength,
    CAST(min(p_partkey) % 365 AS INTEGER) AS seasonal_phase,
    CAST((min(p_partkey) % 18) / 10 + 1 AS DECIMAL(6,3)) AS price_elasticity,
    CAST(min(p_partkey) AS BIGINT) AS kafka_offset
  FROM part GROUP BY p_type
),
promos_t AS (
  SELECT promotion_id, sku_id, store_id, business_date AS start_date,
    CAST(business_date + CAST(l_linenumber * 3 AS INTEGER) AS DATE) AS end_date,
    discount_pct, l_linenumber % 2 = 0 AS feature_display,
    'campaign-' || CAST(year(business_date) AS VARCHAR) AS campaign_name,
    kafka_partition, kafka_offset
  FROM sales_ev WHERE is_promo_row
),
sales_json AS (
  SELECT *, json_object(
    'business_date', datediff('day', DATE '1970-01-01', business_date),
    'discount_pct', CAST(discount_pct AS VARCHAR),
    'gross_revenue', CAST(gross_revenue AS VARCHAR),
    'inventory_on_hand', inventory_on_hand,
    'is_stockout', is_stockout,
    'net_revenue', CAST(net_revenue AS VARCHAR),
    'promotion_id', promotion_id,
    'sale_ts', strftime(sale_ts, '%Y-%m-%dT%H:%M:%SZ'),
    'sku_id', sku_id,
    'store_id', store_id,
    'transaction_id', transaction_id,
    'unit_price', CAST(unit_price AS VARCHAR),
    'units', units) AS payload
  FROM sales_ev
),
messages AS (
  SELECT '{topic("sales_transactions")}' AS topic, kafka_partition, kafka_offset,
    'sales_transactions' AS source_table, operation, event_ts_ms, event_ts_ms AS source_lsn,
    CAST(json_object('transaction_id', transaction_id) AS VARCHAR) AS kafka_key,
    CAST(payload AS VARCHAR) AS record_data, false AS is_snapshot, operation = 'd' AS is_deleted, is_redelivered
  FROM sales_json
  UNION ALL
  SELECT '{topic("stores")}', 0, kafka_offset, 'stores', 'r', epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'),
    epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'), CAST(json_object('store_id', store_id) AS VARCHAR),
    CAST(json_object('demand_multiplier', CAST(demand_multiplier AS VARCHAR),
      'opened_on', datediff('day', DATE '1970-01-01', opened_on), 'region', region,
      'square_feet', square_feet, 'store_format', store_format, 'store_id', store_id,
      'store_name', store_name) AS VARCHAR), true, false, false
  FROM stores_t
  UNION ALL
  SELECT '{topic("products")}', 0, kafka_offset, 'products', 'r', epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'),
    epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'), CAST(json_object('sku_id', sku_id) AS VARCHAR),
    CAST(json_object('base_daily_demand', CAST(base_daily_demand AS VARCHAR), 'brand', brand,
      'category', category, 'price_elasticity', CAST(price_elasticity AS VARCHAR),
      'product_name', product_name, 'seasonal_phase', seasonal_phase,
      'seasonality_strength', CAST(seasonality_strength AS VARCHAR), 'shelf_life_days', shelf_life_days,
      'sku_id', sku_id, 'unit_cost', CAST(unit_cost AS VARCHAR), 'unit_price', CAST(unit_price AS VARCHAR))
      AS VARCHAR), true, false, false
  FROM products_t
  UNION ALL
  SELECT '{topic("promotions")}', kafka_partition, kafka_offset, 'promotions', 'r',
    epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'), epoch_ms(TIMESTAMP '{SNAPSHOT_AT}'),
    CAST(json_object('promotion_id', promotion_id) AS VARCHAR),
    CAST(json_object('campaign_name', campaign_name, 'discount_pct', CAST(discount_pct AS VARCHAR),
      'end_date', datediff('day', DATE '1970-01-01', end_date), 'feature_display', feature_display,
      'promotion_id', promotion_id, 'sku_id', sku_id,
      'start_date', datediff('day', DATE '1970-01-01', start_date), 'store_id', store_id) AS VARCHAR),
    true, false, false
  FROM promos_t
),
msg AS (
  SELECT *, sha256(topic || ':' || CAST(kafka_partition AS VARCHAR) || ':' || CAST(kafka_offset AS VARCHAR))
    AS ingest_id
  FROM messages
),
gold AS (
  SELECT store_id, sku_id, business_date,
    CAST(SUM(units) AS BIGINT) AS units_sold,
    COUNT(transaction_id) AS transaction_count,
    CAST(SUM(gross_revenue) AS DOUBLE) AS gross_revenue,
    CAST(SUM(net_revenue) AS DOUBLE) AS net_revenue,
    CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_unit_price,
    CAST(SUM(discount_pct) AS DOUBLE) / COUNT(discount_pct) AS avg_discount_pct,
    CAST(COUNT(*) FILTER (WHERE is_stockout) AS BIGINT) AS stockout_transaction_count,
    CAST(COUNT(*) FILTER (WHERE is_stockout) AS DOUBLE) / COUNT(transaction_id) AS stockout_rate,
    COUNT(promotion_id) AS promo_transaction_count,
    CAST(SUM(CASE WHEN promotion_id IS NOT NULL THEN units ELSE 0 END) AS BIGINT) AS promo_units,
    MIN(sale_ts) AS first_sale_at,
    MAX(sale_ts) AS last_sale_at,
    CAST(COUNT(*) AS BIGINT) AS source_event_count
  FROM current_tx
  GROUP BY store_id, sku_id, business_date
),
demand AS (SELECT store_id, sku_id, business_date, CAST(units_sold AS DOUBLE) AS units_sold FROM gold),
bounds AS (SELECT min(business_date) AS lo, max(business_date) AS hi FROM demand),
series AS (SELECT DISTINCT store_id, sku_id FROM demand),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS business_date FROM bounds),
panel AS (
  SELECT s.store_id, s.sku_id, c.business_date, COALESCE(d.units_sold, 0.0) AS units_sold
  FROM series s CROSS JOIN cal c
  LEFT JOIN demand d ON d.store_id = s.store_id AND d.sku_id = s.sku_id AND d.business_date = c.business_date
),
win AS (
  SELECT lo AS train_start, CAST(hi - 27 AS DATE) AS test_start, hi AS test_end,
    CAST(hi - 28 AS DATE) AS cutoff_date FROM bounds
),
train AS (SELECT p.* FROM panel p, win WHERE p.business_date < win.test_start),
test AS (SELECT p.* FROM panel p, win WHERE p.business_date >= win.test_start AND p.business_date <= win.test_end),
tmean AS (
  SELECT store_id, sku_id,
    CAST(SUM(CAST(units_sold AS DECIMAL(28,8))) AS DOUBLE) / COUNT(units_sold) AS trailing_mean
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id, sku_id ORDER BY business_date DESC) AS rn FROM train)
  WHERE rn <= 7 GROUP BY store_id, sku_id
),
fc0 AS (
  SELECT t.store_id, t.sku_id, t.business_date, win.cutoff_date, t.units_sold AS actual_units,
    greatest(0.0, coalesce(h.units_sold, m.trailing_mean, 0.0)) AS forecast_units
  FROM test t CROSS JOIN win
  LEFT JOIN train h ON h.store_id = t.store_id AND h.sku_id = t.sku_id
    AND h.business_date = CAST(t.business_date
      - CAST(7 * ceil(datediff('day', win.cutoff_date, t.business_date) / 7.0) AS INTEGER) AS DATE)
  LEFT JOIN tmean m ON m.store_id = t.store_id AND m.sku_id = t.sku_id
),
fc AS (
  SELECT store_id, sku_id, business_date, cutoff_date, 'seasonal_naive_weekly' AS model,
    actual_units, forecast_units, actual_units - forecast_units AS error,
    abs(actual_units - forecast_units) AS absolute_error
  FROM fc0
),
metrics AS (
  SELECT COUNT(*) AS rows,
    COUNT(DISTINCT (store_id, sku_id)) AS series_count,
    CAST(SUM(CAST(actual_units AS DECIMAL(28,8))) AS DOUBLE) AS actual_units,
    CAST(SUM(CAST(forecast_units AS DECIMAL(28,8))) AS DOUBLE) AS forecast_units,
    CAST(SUM(CAST(absolute_error AS DECIMAL(28,8))) AS DOUBLE) / COUNT(absolute_error) AS mae,
    sqrt(CAST(SUM(CAST(error * error AS DECIMAL(28,8))) AS DOUBLE) / COUNT(error)) AS rmse,
    CAST(SUM(CAST(CASE WHEN actual_units > 0 THEN absolute_error / actual_units END AS DECIMAL(28,8))) AS DOUBLE)
      / COUNT(*) FILTER (WHERE actual_units > 0) * 100 AS mape_positive_actual_pct,
    CASE WHEN SUM(CAST(actual_units AS DECIMAL(28,8))) > 0
      THEN CAST(SUM(CAST(absolute_error AS DECIMAL(28,8))) AS DOUBLE)
        / CAST(SUM(CAST(actual_units AS DECIMAL(28,8))) AS DOUBLE) * 100 END AS wmape_pct,
    CAST(SUM(CAST(error AS DECIMAL(28,8))) AS DOUBLE) / COUNT(error) AS bias_units,
    CAST(SUM(CAST(greatest(0.5 * error, (CAST(0.5 AS DOUBLE) - 1.0) * error) AS DECIMAL(28,8))) AS DOUBLE)
      / COUNT(error) AS pinball_loss_p50
  FROM fc
),
promo_days AS (
  SELECT store_id, sku_id, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE)
    AS business_date, promotion_id, discount_pct, feature_display
  FROM promos_t WHERE end_date >= start_date
),
promo_win AS (
  SELECT store_id, sku_id, business_date,
    arg_min(promotion_id, promotion_id) AS promotion_id,
    arg_min(discount_pct, promotion_id) AS promo_discount_pct,
    arg_min(feature_display, promotion_id) AS promo_feature_display
  FROM promo_days GROUP BY store_id, sku_id, business_date
)"""


def with_base(select: str) -> str:
    return f"WITH {BASE}\n{select}"


ORACLE: dict[str, str] = {}

# --------------------------------------------------------- bronze / landing

_BRONZE_COLS = """SELECT ingest_id, topic, kafka_partition, kafka_offset, 'retail' AS source_schema, source_table,
  operation, event_ts_ms, source_lsn, kafka_key FROM msg"""
ORACLE["bronze_rows"] = with_base(_BRONZE_COLS)
ORACLE["land_bronze_stream"] = with_base(_BRONZE_COLS)
ORACLE["ingest_ids"] = with_base("""
SELECT topic, kafka_partition, kafka_offset, ingest_id FROM msg
UNION ALL
SELECT topic, kafka_partition, kafka_offset, ingest_id FROM msg WHERE is_redelivered""")
ORACLE["inspect_table"] = with_base("SELECT source_table, COUNT(*) AS rows FROM msg GROUP BY source_table")
ORACLE["land_out_of_order"] = with_base("SELECT topic, kafka_partition, kafka_offset, ingest_id FROM msg")
ORACLE["stream_dedup"] = with_base("SELECT topic, kafka_partition, kafka_offset, ingest_id FROM msg")

ORACLE["stream_watermark_dedup"] = with_base("""
, sent AS (
  SELECT *, epoch_ms(event_ts_ms) + CASE WHEN coalesce(is_redelivered, FALSE) THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS newest FROM msg
)
SELECT topic, kafka_partition, kafka_offset FROM sent
WHERE kafka_offset % 7 <> 0 OR newest > (SELECT max(newest) FROM sent WHERE kafka_offset % 7 <> 0) - INTERVAL 1000 DAY""")
ORACLE["replay_offset_ranges"] = with_base("""
, ends AS (SELECT topic, kafka_partition, max(kafka_offset) AS last FROM msg GROUP BY ALL)
SELECT topic, kafka_partition, kafka_offset, ingest_id FROM msg JOIN ends USING (topic, kafka_partition)
WHERE kafka_offset >= last // 3 AND kafka_offset < 2 * last // 3""")

# ------------------------------------------------------------------ silver

ORACLE["silver_events"] = with_base("""
SELECT ingest_id AS event_id, kafka_key AS record_key, 'retail' AS source_schema, source_table, operation,
  CASE operation WHEN 'r' THEN 'snapshot_read' WHEN 'c' THEN 'create' WHEN 'u' THEN 'update'
    WHEN 'd' THEN 'delete' END AS operation_name,
  is_snapshot, is_deleted, epoch_ms(event_ts_ms) AS event_at, CAST(epoch_ms(event_ts_ms) AS DATE) AS event_date,
  source_lsn, topic AS kafka_topic, kafka_partition, kafka_offset, record_data
FROM msg""")

ORACLE["operation_mix"] = with_base("""
SELECT source_table, operation,
  CASE operation WHEN 'r' THEN 'snapshot_read' WHEN 'c' THEN 'create' WHEN 'u' THEN 'update'
    WHEN 'd' THEN 'delete' END AS operation_name,
  is_snapshot, is_deleted, COUNT(*) AS events
FROM msg GROUP BY ALL""")

ORACLE["canonical_json"] = with_base("""
SELECT topic, kafka_partition, kafka_offset,
  CAST(json_object(
    'after', CASE WHEN operation <> 'd' THEN CAST(record_data AS JSON) END,
    'before', CASE WHEN operation = 'd' THEN CAST(record_data AS JSON) END,
    'op', operation,
    'source', json_object('lsn', source_lsn, 'schema', 'retail', 'snapshot', CASE WHEN is_snapshot THEN 'true' ELSE 'false' END,
                          'table', source_table, 'ts_ms', event_ts_ms),
    'ts_ms', event_ts_ms) AS VARCHAR) AS canonical_value
FROM msg""")

ORACLE["dedup_coordinates"] = with_base(f"""
SELECT topic, kafka_partition, kafka_offset, ingest_id, source_table, operation,
  CASE WHEN is_redelivered THEN TIMESTAMP '{REDELIVERY_LANDED_AT}' ELSE TIMESTAMP '{AS_OF}' END AS ingested_at
FROM msg""")

ORACLE["source_table_counts"] = with_base("SELECT source_table, COUNT(*) AS rows FROM msg GROUP BY source_table")

ORACLE["silver_summary"] = with_base("""
SELECT (SELECT COUNT(*) FROM msg) + (SELECT COUNT(*) FROM msg WHERE is_redelivered) AS bronze_rows,
  COUNT(*) AS silver_rows, COUNT(DISTINCT source_table) AS source_tables,
  COUNT(*) FILTER (WHERE is_snapshot) AS snapshot_events, COUNT(*) FILTER (WHERE is_deleted) AS delete_events,
  CAST(min(epoch_ms(event_ts_ms)) AS DATE) AS min_event_date, CAST(max(epoch_ms(event_ts_ms)) AS DATE)
    AS max_event_date
FROM msg""")

ORACLE["run_metadata"] = with_base("""
, counts AS (
  SELECT source_table, COUNT(*) AS rows, CAST(min(epoch_ms(event_ts_ms)) AS DATE) AS first, CAST(max(epoch_ms(event_ts_ms)) AS DATE) AS last
  FROM msg GROUP BY source_table
)
SELECT 'mode' AS key, 'string' AS kind, 'overwrite' AS value
UNION ALL SELECT 'silver_rows', 'bigint', CAST(CAST(sum(rows) AS BIGINT) AS VARCHAR) FROM counts
UNION ALL SELECT 'gate_passed', 'boolean', 'true'
UNION ALL SELECT 'output_dir', 'none', 'None'
UNION ALL SELECT 'source_table_counts', 'json', '{' || string_agg('"' || source_table || '":' || rows, ',' ORDER BY source_table) || '}' FROM counts
UNION ALL SELECT 'date_range', 'json', '{"min":"' || min(first) || '","max":"' || max(last) || '"}' FROM counts
UNION ALL SELECT 'last_event_date', 'text', CAST(max(last) AS VARCHAR) FROM counts""")

# -------------------------------------------------------------------- gold

_TYPED = f"""transaction_id, store_id, sku_id, business_date, sale_ts, units,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(gross_revenue AS DOUBLE) AS gross_revenue, CAST(net_revenue AS DOUBLE) AS net_revenue,
  inventory_on_hand, is_stockout, promotion_id, CAST(1 AS BIGINT) AS source_event_count,
  epoch_ms(event_ts_ms) AS event_at, event_ts_ms AS source_lsn, '{topic("sales_transactions")}' AS kafka_topic,
  kafka_partition, kafka_offset, operation = 'd' AS is_deleted"""

ORACLE["sales_transactions_typed"] = with_base(f"SELECT {_TYPED} FROM sales_ev")
ORACLE["current_transactions"] = with_base(f"SELECT {_TYPED} FROM current_tx")
ORACLE["gold_daily_demand"] = with_base("SELECT * FROM gold")
ORACLE["gold_append_after_delete"] = with_base("SELECT * FROM gold WHERE day(business_date) <> 1")
ORACLE["payload_violations"] = with_base("""
SELECT COUNT(*) AS live_rows, 0::BIGINT AS transaction_id, COUNT(*) FILTER (WHERE units > 45) AS store_id, 0::BIGINT AS sku_id,
  0::BIGINT AS business_date, 0::BIGINT AS sale_ts, COUNT(*) FILTER (WHERE units % 10 = 0) AS units, 0::BIGINT AS unit_price,
  0::BIGINT AS discount_pct, 0::BIGINT AS gross_revenue, COUNT(*) FILTER (WHERE is_stockout) AS net_revenue,
  0::BIGINT AS inventory_on_hand, 0::BIGINT AS is_stockout
FROM current_tx""")
ORACLE["lakehouse_end_to_end"] = with_base("SELECT * FROM gold")

ORACLE["gold_summary"] = with_base("""
SELECT (SELECT COUNT(*) FROM msg) AS silver_rows, (SELECT COUNT(*) FROM current_tx) AS current_transaction_rows,
  COUNT(*) AS gold_rows, min(business_date) AS min_business_date, max(business_date) AS max_business_date,
  CAST(SUM(units_sold) AS BIGINT) AS units_sold
FROM gold""")

ORACLE["date_decoding"] = with_base("""
, decoded AS (
  SELECT 'sales_transactions' AS source_table, 'business_date' AS field, business_date AS decoded FROM sales_ev
  UNION SELECT 'stores', 'opened_on', opened_on FROM stores_t
  UNION SELECT 'promotions', 'start_date', start_date FROM promos_t
  UNION SELECT 'promotions', 'end_date', end_date FROM promos_t
)
SELECT source_table, field, CAST(datediff('day', DATE '1970-01-01', decoded) AS INTEGER) AS epoch_day, decoded FROM decoded""")

# ----------------------------------------------------------------- quality


def _suite_sql(suite: Q.Suite, total: str, dup_rows: str) -> str:
    parts = []
    for i, e in enumerate(suite.expectations):
        col = "NULL" if e.column is None else "'" + e.column + "'"
        unexpected = dup_rows if e.type == Q.UNIQUE else "0"
        success = f"({dup_rows}) = 0" if e.type == Q.UNIQUE else "true"
        parts.append(
            f"SELECT '{suite.name}' AS suite_name, {i} AS ordinal, '{e.type}' AS expectation_type, "
            f"CAST({col} AS VARCHAR) AS column_name, CAST(({total}) AS BIGINT) AS element_count, "
            f"CAST(({unexpected}) AS BIGINT) AS unexpected_count, {success} AS success"
        )
    return "\nUNION ALL\n".join(parts)


ORACLE["bronze_quality"] = with_base(_suite_sql(
    Q.bronze_to_silver_suite(),
    "(SELECT COUNT(*) FROM msg) + (SELECT COUNT(*) FROM msg WHERE is_redelivered)",
    "2 * (SELECT COUNT(*) FROM msg WHERE is_redelivered)",
))


def _rules_sql(suite: str, rules: list[tuple[str, str, int | None]], null_keys: str) -> str:
    """Written out per rule: (type, column, residue of the offset modulo 31 at which rows break it)."""
    n = "(SELECT COUNT(*) FROM msg) + (SELECT COUNT(*) FROM msg WHERE kafka_offset % 31 = 25)"
    parts = []
    for i, (kind, column, residue) in enumerate(rules):
        unique = kind == "expect_compound_columns_to_be_unique"
        times = 2 if unique else 1
        # rows with a null key part do not count for uniqueness
        rows = f"{n} - (SELECT COUNT(*) FROM msg WHERE kafka_offset % 31 IN {null_keys})" if unique else n
        bad = "0" if residue is None else f"{times} * (SELECT COUNT(*) FROM msg WHERE kafka_offset % 31 = {residue})"
        parts.append(f"SELECT '{suite}' AS suite_name, {i} AS ordinal, '{kind}' AS expectation_type, CAST({column} AS VARCHAR) AS column_name, "
                     f"CAST({rows} AS BIGINT) AS element_count, CAST({bad} AS BIGINT) AS unexpected_count, {bad} = 0 AS success")
    return "\nUNION ALL\n".join(parts)


_SET, _NULL, _JSON = "expect_column_values_to_be_in_set", "expect_column_values_to_not_be_null", "expect_column_values_to_be_json_parseable"
_HEAD = [("expect_table_row_count_to_be_between", "NULL", None)]
_SETS = [(_SET, "'source_schema'", 20), (_SET, "'source_table'", 21), (_SET, "'operation'", 22)]
_BRONZE_RULES = [
    ("expect_table_columns_to_match_set", "'ingest_id,ingested_at,ingest_date,topic,kafka_partition,kafka_offset,source_schema,source_table,"
     "operation,event_ts_ms,source_lsn,kafka_key,debezium_value'", None), *_HEAD,
    (_NULL, "'ingest_id'", 0), (_NULL, "'ingested_at'", 1), (_NULL, "'ingest_date'", 2), (_NULL, "'topic'", 3), (_NULL, "'kafka_partition'", 4),
    (_NULL, "'kafka_offset'", 5), (_NULL, "'source_schema'", 6), (_NULL, "'source_table'", 7), (_NULL, "'operation'", 8),
    (_NULL, "'event_ts_ms'", 9), (_NULL, "'kafka_key'", 10), (_NULL, "'debezium_value'", 11),
    ("expect_compound_columns_to_be_unique", "'topic,kafka_partition,kafka_offset'", 25), *_SETS,
    (_JSON, "'kafka_key'", 23), (_JSON, "'debezium_value'", 24),
]
_SILVER_RULES = [
    ("expect_table_columns_to_match_set", "'event_id,record_key,source_schema,source_table,operation,operation_name,is_snapshot,is_deleted,event_at,"
     "event_date,source_lsn,kafka_topic,kafka_partition,kafka_offset,record_data,ingested_at,silver_loaded_at'", None), *_HEAD,
    (_NULL, "'event_id'", 0), (_NULL, "'record_key'", 1), (_NULL, "'source_schema'", 2), (_NULL, "'source_table'", 3), (_NULL, "'operation'", 4),
    (_NULL, "'operation_name'", 5), (_NULL, "'is_snapshot'", 6), (_NULL, "'is_deleted'", 7), (_NULL, "'event_at'", 8), (_NULL, "'event_date'", 9),
    (_NULL, "'kafka_topic'", 10), (_NULL, "'kafka_partition'", 11), (_NULL, "'kafka_offset'", 12), (_NULL, "'record_data'", 13),
    (_NULL, "'ingested_at'", 14), (_NULL, "'silver_loaded_at'", 15),
    ("expect_compound_columns_to_be_unique", "'kafka_topic,kafka_partition,kafka_offset'", 25), *_SETS,
    (_JSON, "'record_key'", 23), (_JSON, "'record_data'", 24),
]
ORACLE["bronze_quality_broken"] = with_base(_rules_sql("bronze_to_silver_cdc_events", _BRONZE_RULES, "(3, 4, 5)"))
ORACLE["silver_quality_broken"] = with_base(_rules_sql("silver_to_gold_retail_cdc_events", _SILVER_RULES, "(10, 11, 12)"))
ORACLE["gate_summary"] = with_base(f"""
SELECT suite_name, bool_and(success) AS success, COUNT(*) AS evaluated_expectations,
  COUNT(*) FILTER (WHERE success) AS successful_expectations, COUNT(*) FILTER (WHERE NOT success) AS unsuccessful_expectations,
  string_agg(expectation_type, ';' ORDER BY ordinal) FILTER (WHERE NOT success) AS failure_messages
FROM ({_rules_sql("bronze_to_silver_cdc_events", _BRONZE_RULES, "(3, 4, 5)")}) GROUP BY suite_name""")
ORACLE["silver_quality"] = with_base(_suite_sql(Q.silver_to_gold_suite(), "(SELECT COUNT(*) FROM msg)", "0"))

# CHECK predicates in SQL (mirror of operators.constraints.VALUE_CHECKS).
_SQL_CHECKS = {
    "stores": {"square_feet_positive": "square_feet > 0", "demand_multiplier_positive": "demand_multiplier > 0"},
    "products": {
        "unit_cost_non_negative": "unit_cost >= 0",
        "unit_price_at_least_cost": "unit_price >= unit_cost",
        "shelf_life_positive": "shelf_life_days > 0",
        "base_demand_positive": "base_daily_demand > 0",
        "seasonality_non_negative": "seasonality_strength >= 0",
        "seasonal_phase_in_year": "seasonal_phase BETWEEN 0 AND 364",
        "elasticity_positive": "price_elasticity > 0",
    },
    "promotions": {
        "discount_in_range": "discount_pct >= 0 AND discount_pct < 1",
        "end_not_before_start": "end_date >= start_date",
    },
    "sales_transactions": {
        "units_positive": "units > 0",
        "unit_price_non_negative": "unit_price >= 0",
        "discount_in_range": "discount_pct >= 0 AND discount_pct < 1",
        "gross_revenue_non_negative": "gross_revenue >= 0",
        "net_revenue_non_negative": "net_revenue >= 0",
        "inventory_non_negative": "inventory_on_hand >= 0",
    },
}
_TABLE_CTE = {"stores": "stores_t", "products": "products_t", "promotions": "promos_t",
              "sales_transactions": "current_tx"}
_FKS = [
    ("promotions", "sku_id", "products", "sku_id"),
    ("promotions", "store_id", "stores", "store_id"),
    ("sales_transactions", "store_id", "stores", "store_id"),
    ("sales_transactions", "sku_id", "products", "sku_id"),
    ("sales_transactions", "promotion_id", "promotions", "promotion_id"),
]


def _fk_sql(child: str, ccol: str, parent: str, pcol: str) -> str:
    c, p = _TABLE_CTE[child], _TABLE_CTE[parent]
    return (f"(SELECT COUNT(*) FROM {c} x WHERE x.{ccol} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {p} y WHERE y.{pcol} = x.{ccol}))")


def _constraint_sql() -> str:
    parts = []
    for table, schema in RETAIL_TABLE_SCHEMAS.items():
        cte = _TABLE_CTE[table]
        for f in schema.fields:
            if table == "sales_transactions" and f.name == "promotion_id":
                continue
            parts.append(f"SELECT '{table}' AS table_name, 'not_null:{f.name}' AS check_name, "
                         f"(SELECT COUNT(*) FROM {cte} WHERE {f.name} IS NULL) AS violations")
        for name, pred in _SQL_CHECKS[table].items():
            parts.append(f"SELECT '{table}', 'check:{name}', (SELECT COUNT(*) FROM {cte} WHERE NOT ({pred}))")
        pk = PRIMARY_KEYS[table]
        parts.append(f"SELECT '{table}', 'primary_key:{pk}', (SELECT COALESCE(SUM(c), 0) FROM "
                     f"(SELECT COUNT(*) AS c FROM {cte} WHERE {pk} IS NOT NULL GROUP BY {pk}) WHERE c > 1)")
    for child, ccol, parent, pcol in _FKS:
        parts.append(f"SELECT '{child}', 'foreign_key:{ccol}->{parent}', {_fk_sql(child, ccol, parent, pcol)}")
    return "\nUNION ALL\n".join(parts)


ORACLE["constraint_report"] = with_base(
    "SELECT table_name, check_name, CAST(violations AS BIGINT) AS violations FROM (\n" + _constraint_sql() + "\n)")

ORACLE["fk_violations"] = with_base("\nUNION ALL\n".join(
    f"SELECT '{child}' AS child_table, '{ccol}' AS child_column, '{parent}' AS parent_table, "
    f"'{pcol}' AS parent_column, CAST({_fk_sql(child, ccol, parent, pcol)} AS BIGINT) AS violations, "
    f"(SELECT COUNT({ccol}) FROM {_TABLE_CTE[child]}) AS checked_rows"
    for child, ccol, parent, pcol in _FKS
))

ORACLE["inventory_cap_violations"] = with_base("""
SELECT * FROM (
  SELECT store_id, sku_id, business_date, CAST(SUM(units) AS BIGINT) AS units_sold,
    CAST(MAX(inventory_on_hand) AS BIGINT) AS inventory_on_hand
  FROM current_tx GROUP BY store_id, sku_id, business_date
) WHERE units_sold > inventory_on_hand""")

ORACLE["load_retail_tables"] = with_base("""
SELECT 'stores' AS table_name, COUNT(*) AS rows FROM stores_t
UNION ALL SELECT 'products', COUNT(*) FROM products_t
UNION ALL SELECT 'promotions', COUNT(*) FROM promos_t
UNION ALL SELECT 'sales_transactions', COUNT(*) FROM current_tx""")

# ---------------------------------------------------------------- forecast

ORACLE["demand_panel"] = with_base("SELECT * FROM panel")

ORACLE["evaluation_window"] = with_base("""
SELECT train_start, test_start, test_end, cutoff_date,
  (SELECT COUNT(DISTINCT business_date) FROM panel) AS available_days FROM win""")

ORACLE["train_test_split"] = with_base("""
SELECT 'train' AS split, COUNT(*) AS rows, COUNT(DISTINCT (store_id, sku_id)) AS series,
  min(business_date) AS min_date, max(business_date) AS max_date FROM train
UNION ALL
SELECT 'test', COUNT(*), COUNT(DISTINCT (store_id, sku_id)), min(business_date), max(business_date) FROM test""")

ORACLE["trailing_mean"] = with_base("SELECT * FROM tmean")
ORACLE["seasonal_naive"] = with_base("SELECT * FROM fc")
ORACLE["forecast_metrics"] = with_base("SELECT * FROM metrics")
ORACLE["forecast_report"] = with_base("""
SELECT rows, series_count, round(actual_units, 4) AS actual_units, round(forecast_units, 4) AS forecast_units, round(mae, 4) AS mae,
  round(rmse, 4) AS rmse, round(mape_positive_actual_pct, 4) AS mape_positive_actual_pct, round(wmape_pct, 4) AS wmape_pct,
  round(bias_units, 4) AS bias_units, round(pinball_loss_p50, 4) AS pinball_loss_p50
FROM metrics""")


def _pinball(q: float) -> str:
    return (f"SELECT CAST({q!r} AS DOUBLE) AS quantile, CAST(SUM(CAST(greatest(CAST({q!r} AS DOUBLE) * error, "
            f"(CAST({q!r} AS DOUBLE) - 1.0) * error) AS DECIMAL(28,8))) AS DOUBLE) / COUNT(error) AS pinball_loss "
            f"FROM fc")


ORACLE["pinball_loss"] = with_base("\nUNION ALL\n".join(_pinball(q) for q in (0.1, 0.5, 0.9)))

ORACLE["baseline_evaluation"] = with_base("""
SELECT 'seasonal_naive_weekly' AS model, win.train_start, win.test_start, win.test_end,
  (SELECT COUNT(*) FROM panel) AS panel_rows, metrics.*
FROM win, metrics""")

# ----------------------------------------------------------------- drivers

ORACLE["active_promotion"] = with_base("""
SELECT g.store_id, g.sku_id, g.business_date, g.units_sold, w.promotion_id,
  CAST(w.promo_discount_pct AS DOUBLE) AS promo_discount_pct, w.promo_feature_display
FROM gold g JOIN promo_win w USING (store_id, sku_id, business_date)""")

ORACLE["gold_promotions"] = with_base("""
SELECT g.store_id, g.sku_id, g.business_date, g.units_sold, w.promotion_id,
  CAST(w.promo_discount_pct AS DOUBLE) AS promo_discount_pct, w.promo_feature_display
FROM gold g LEFT JOIN promo_win w USING (store_id, sku_id, business_date)""")

_LIFT = ("(CAST(1.0 AS DOUBLE) + (CAST({d} AS DOUBLE) * CAST({e} AS DOUBLE) "
         "+ CASE WHEN {f} THEN CAST(0.18 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END))")

ORACLE["promotion_lift"] = with_base(f"""
SELECT p.promotion_id, p.sku_id, p.store_id,
  {_LIFT.format(d="p.discount_pct", e="r.price_elasticity", f="p.feature_display")} AS promotion_lift
FROM promos_t p JOIN products_t r ON p.sku_id = r.sku_id""")

_WEEKDAY = "[0.86, 0.90, 0.96, 1.05, 1.20, 1.34, 1.15]"


def _trend(offset: str) -> str:
    return f"(CAST(1.0 AS DOUBLE) + least({offset} * CAST(0.00045 AS DOUBLE), CAST(0.18 AS DOUBLE)))"


def _payday(d: str) -> str:
    return f"(CASE WHEN day({d}) IN (1, 15, 30, 31) THEN CAST(1.08 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)"


def _weekday_mult(d: str) -> str:
    return f"CAST({_WEEKDAY}[isodow({d})] AS DOUBLE)"


ORACLE["calendar_features"] = with_base(f"""
SELECT business_date, CAST(isodow(business_date) - 1 AS INTEGER) AS weekday,
  {_weekday_mult('business_date')} AS weekday_multiplier,
  CAST(dayofyear(business_date) AS INTEGER) AS day_of_year, CAST(day(business_date) AS INTEGER) AS day_of_month,
  {_payday('business_date')} AS payday_multiplier,
  CAST(datediff('day', s.start, business_date) AS INTEGER) AS day_offset,
  {_trend("CAST(datediff('day', s.start, business_date) AS INTEGER)")} AS trend_multiplier
FROM (SELECT DISTINCT business_date FROM current_tx),
     (SELECT min(business_date) AS start FROM current_tx) s""")

ORACLE["expected_demand"] = with_base(f"""
SELECT g.store_id, g.sku_id, g.business_date, w.promotion_id,
  CASE WHEN w.promo_discount_pct IS NULL THEN CAST(1.0 AS DOUBLE)
    ELSE {_LIFT.format(d="w.promo_discount_pct", e="p.price_elasticity", f="w.promo_feature_display")} END
    AS promotion_lift,
  greatest(
    CAST(p.base_daily_demand AS DOUBLE) * CAST(s.demand_multiplier AS DOUBLE)
    * {_weekday_mult('g.business_date')}
    * (CAST(1.0 AS DOUBLE) + CAST(p.seasonality_strength AS DOUBLE)
       * sin(CAST(6.283185307179586 AS DOUBLE)
             * ((dayofyear(g.business_date) - p.seasonal_phase) / CAST(365.0 AS DOUBLE))))
    * {_trend("CAST(datediff('day', b.start, g.business_date) AS INTEGER)")}
    * {_payday('g.business_date')}
    * CASE WHEN w.promo_discount_pct IS NULL THEN CAST(1.0 AS DOUBLE)
        ELSE {_LIFT.format(d="w.promo_discount_pct", e="p.price_elasticity", f="w.promo_feature_display")} END,
    CAST(0.05 AS DOUBLE)) AS expected_demand
FROM gold g
LEFT JOIN promo_win w USING (store_id, sku_id, business_date)
JOIN stores_t s ON s.store_id = g.store_id
JOIN products_t p ON p.sku_id = g.sku_id,
(SELECT min(business_date) AS start FROM gold) b""")

ORACLE["stockout_flags"] = with_base("""
SELECT transaction_id, CAST(units AS BIGINT) AS latent_units, CAST(inventory_on_hand AS BIGINT) AS inventory_on_hand,
  CAST(least(units, inventory_on_hand) AS BIGINT) AS observed_units, units > inventory_on_hand AS is_stockout
FROM current_tx""")

ORACLE["revenue_lines"] = with_base("""
SELECT transaction_id, units,
  CAST(round(unit_price * (1 - discount_pct), 2) AS DOUBLE) AS effective_unit_price,
  CAST(round(CAST(units AS DECIMAL(10,0)) * unit_price, 2) AS DOUBLE) AS gross_revenue,
  CAST(round(CAST(units AS DECIMAL(10,0)) * CAST(round(unit_price * (1 - discount_pct), 2) AS DECIMAL(10,2)), 2)
    AS DOUBLE) AS net_revenue
FROM current_tx""")


# ------------------------------------------- state, streams, planning, history

ORACLE["stream_current_state"] = ORACLE["current_transactions"]

ORACLE["stream_daily_demand"] = with_base("""
, arriving AS (
  SELECT *, CAST(least(3, greatest(0, (year(sale_ts) - 1992) // 2) + CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS wave
  FROM current_tx
), mark AS (
  SELECT wave, max(max(sale_ts)) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - INTERVAL 2 DAY AS after_wave
  FROM arriving GROUP BY wave
), judged AS (
  SELECT a.*, CAST(sale_ts AS DATE) + INTERVAL 1 DAY AS day_end,
    (SELECT max(after_wave) FROM mark m WHERE m.wave < a.wave) AS before, (SELECT max(after_wave) FROM mark) AS last
  FROM arriving a
)
SELECT store_id, sku_id, CAST(sale_ts AS DATE) AS business_date, CAST(sum(units) AS BIGINT) AS units_sold, count(*) AS sales,
  CASE WHEN day_end <= before THEN 'late' ELSE 'closed' END AS state
FROM judged WHERE day_end <= last GROUP BY ALL""")

_CONFORMAL = """
, slice AS (
  SELECT p.*, CAST(p.business_date - CAST(7 * ceil(datediff('day', CAST(win.cutoff_date - 28 AS DATE), p.business_date) / 7.0) AS INTEGER) AS DATE) AS lag_day
  FROM panel p JOIN win ON p.business_date > win.cutoff_date - 28 AND p.business_date <= win.cutoff_date
), calib AS (
  SELECT c.store_id, c.sku_id, abs(c.units_sold - greatest(0.0, coalesce(h.units_sold, 0.0))) AS miss
  FROM slice c JOIN panel h ON h.store_id = c.store_id AND h.sku_id = c.sku_id AND h.business_date = c.lag_day
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, sku_id ORDER BY miss) AS r, count(*) OVER (PARTITION BY store_id, sku_id) AS n FROM calib
), radius AS (
  SELECT store_id, sku_id, miss AS radius FROM ranked WHERE r = ceil((n + 1) * 0.9)
), banded AS (
  SELECT store_id, sku_id, business_date, actual_units, forecast_units, radius, greatest(0.0, forecast_units - radius) AS lower_units,
    forecast_units + radius AS upper_units, actual_units BETWEEN greatest(0.0, forecast_units - radius) AND forecast_units + radius AS covered
  FROM fc JOIN radius USING (store_id, sku_id)
)"""
ORACLE["conformal_intervals"] = with_base(_CONFORMAL + " SELECT * FROM banded")
ORACLE["conformal_coverage"] = with_base(_CONFORMAL + """
SELECT count(*) AS rows, count(*) FILTER (WHERE covered) AS covered_rows,
  CAST(count(*) FILTER (WHERE covered) AS DOUBLE) / count(*) AS coverage, 0.9::DOUBLE AS target_coverage,
  CAST(sum(CAST(upper_units - lower_units AS DECIMAL(28,8))) AS DOUBLE) / count(*) AS mean_width FROM banded""")

ORACLE["newsvendor_orders"] = with_base("""
, period AS (
  SELECT store_id, sku_id, sum(units_sold) AS units_sold FROM panel, bounds
  WHERE datediff('day', business_date, hi) // 28 < (datediff('day', lo, hi) + 1) // 28
  GROUP BY store_id, sku_id, datediff('day', business_date, hi) // 28
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY store_id, sku_id ORDER BY units_sold) AS r, count(*) OVER (PARTITION BY store_id, sku_id) AS n
  FROM period
)
SELECT store_id, sku_id, CAST(any_value(unit_price - unit_cost) AS DOUBLE) / CAST(any_value(unit_price) AS DOUBLE) AS critical_ratio,
  min(CASE WHEN r * unit_price >= n * (unit_price - unit_cost) THEN units_sold END) AS order_units
FROM ranked JOIN products_t USING (sku_id) GROUP BY store_id, sku_id""")

ORACLE["policy_backtest"] = with_base("""
, fold AS (SELECT CAST(hi - 28 * CAST(i AS INTEGER) AS DATE) AS cutoff_date, lo FROM bounds, unnest([1, 2, 3]) AS u(i)),
period AS (
  SELECT p.store_id, p.sku_id, f.cutoff_date, sum(p.units_sold) AS units_sold
  FROM panel p JOIN fold f ON p.business_date <= f.cutoff_date
  WHERE datediff('day', p.business_date, f.cutoff_date) // 28 < (datediff('day', f.lo, f.cutoff_date) + 1) // 28
  GROUP BY p.store_id, p.sku_id, f.cutoff_date, datediff('day', p.business_date, f.cutoff_date) // 28
), ranked AS (
  SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY store_id, sku_id, cutoff_date) AS n,
    max(units_sold) OVER (PARTITION BY store_id, sku_id, cutoff_date) AS most
  FROM period WINDOW w AS (PARTITION BY store_id, sku_id, cutoff_date ORDER BY units_sold)
), quantity AS (
  SELECT store_id, sku_id, cutoff_date, min(CASE WHEN r * unit_price >= n * (unit_price - unit_cost) THEN units_sold END) AS q
  FROM ranked JOIN products_t USING (sku_id) GROUP BY ALL HAVING max(most) > 0
), tested AS (
  SELECT p.store_id, p.sku_id, f.cutoff_date, sum(p.units_sold) AS demand, sum(h.units_sold) AS seasonal
  FROM panel p JOIN fold f ON p.business_date > f.cutoff_date AND p.business_date <= f.cutoff_date + 28
  JOIN panel h ON h.store_id = p.store_id AND h.sku_id = p.sku_id
    AND h.business_date = CAST(p.business_date - CAST(7 * ceil(datediff('day', f.cutoff_date, p.business_date) / 7.0) AS INTEGER) AS DATE)
  GROUP BY ALL
), ordered AS (
  SELECT sku_id, cutoff_date, demand, 'seasonal_naive' AS policy, seasonal AS o FROM tested
  UNION ALL
  SELECT sku_id, cutoff_date, demand, 'newsvendor', coalesce(q, 0.0) FROM tested LEFT JOIN quantity USING (store_id, sku_id, cutoff_date)
), costed AS (
  SELECT policy, cutoff_date, CAST(greatest(demand - o, 0) AS DECIMAL(14,2)) * (unit_price - unit_cost) AS u,
    CAST(greatest(o - demand, 0) AS DECIMAL(14,2)) * unit_cost AS v FROM ordered JOIN products_t USING (sku_id)
)
SELECT policy, cutoff_date, count(*) AS orders, 0::BIGINT AS unpriced_orders, CAST(sum(u) AS DOUBLE) AS understock_cost,
  CAST(sum(v) AS DOUBLE) AS overstock_cost, CAST(sum(u) AS DOUBLE) + CAST(sum(v) AS DOUBLE) AS total_cost
FROM costed GROUP BY policy, cutoff_date""")

ORACLE["record_history"] = with_base("""
, chained AS (
  SELECT source_table, kafka_key AS record_key, epoch_ms(event_ts_ms) AS valid_from,
    epoch_ms(lead(event_ts_ms) OVER (PARTITION BY source_table, kafka_key ORDER BY event_ts_ms, source_lsn, topic, kafka_partition, kafka_offset)) AS valid_to,
    record_data, is_deleted FROM msg
)
SELECT source_table, record_key, valid_from, valid_to, record_data FROM chained
WHERE NOT is_deleted AND (valid_to IS NULL OR valid_to > valid_from)""")

ORACLE["gold_as_of_day"] = with_base(f"""
SELECT g.store_id, g.sku_id, g.business_date, g.units_sold, s.region, s.store_format, p.category, CAST(p.unit_price AS DOUBLE) AS list_price
FROM gold g LEFT JOIN stores_t s ON s.store_id = g.store_id AND TIMESTAMP '{SNAPSHOT_AT}' < g.business_date + INTERVAL 1 DAY
LEFT JOIN products_t p ON p.sku_id = g.sku_id AND TIMESTAMP '{SNAPSHOT_AT}' < g.business_date + INTERVAL 1 DAY""")
