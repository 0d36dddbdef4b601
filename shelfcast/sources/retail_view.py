"""Retail view of the star-schema test tables, and the change log it implies.

The engine's real inputs are a Kafka change stream and the four retail tables.
The test tables hold neither, so this module derives both from them with Spark
(pure projections, joins and one per-key window): it is an input adapter, not
an engine feature.  The rules are stated once here and mirrored in SQL by
``shelfcast.plans.oracle`` so that DuckDB can check every query independently.

Mapping (one ``lineitem`` row = one change event of a sales transaction):

* transaction_id = ``<l_orderkey>-<l_linenumber>``; repeated keys form an update history
* version        = 0-based rank of the row within its key, ordered by
                   (l_shipdate, l_partkey, l_suppkey, l_quantity) - a total order
* operation      = ``c`` for version 0; ``d`` for a later version with
                   l_returnflag = 'R' and l_linestatus = 'O'; ``u`` otherwise
* store_id       = customer nation of the order, ``store-NN``; sku_id = p_type
* business_date  = l_shipdate; sale_ts = l_shipdate + (8 + l_linenumber) hours
* money          = decimals: unit_price = p_retailprice, gross = l_extendedprice,
                   net = gross * (1 - l_discount) rounded half-up to cents
* inventory      = p_size; is_stockout = l_returnflag = 'R'
* promotions     = rows with l_discount >= 0.095 and l_quantity >= 45, active
                   [shipdate, shipdate + 3 * l_linenumber]; a sale carries the
                   promotion id of its own row when the row is one
* event time     = sale_ts + version seconds (ms), LSN = event time in ms
* Kafka coords   = partition pmod(l_orderkey, P), offset
                   ((l_orderkey div P) * 8 + l_linenumber - 1) * 8 + version
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import epoch, iso_utc_text
from shelfcast.sources.tables import read_table

TOPIC_PREFIX = "shop"
KAFKA_PARTITIONS = 4
# Fixed landing time of the simulated runs (the wall clock is a parameter, never read).
AS_OF = "2026-01-01 06:00:00"
# Snapshot (op ``r``) events of the dimension tables are read at this instant.
SNAPSHOT_AT = "1995-01-01 00:00:00"

# Store formats of the test-data adapter (format, square feet, demand multiplier),
# picked by nation key modulo 4.
STORE_FORMATS = [
    ("corner", 9000, "0.80"),
    ("market", 22000, "1.00"),
    ("superstore", 52000, "1.30"),
    ("warehouse", 80000, "1.60"),
]


def topic_for(table: str, prefix: str = TOPIC_PREFIX) -> str:
    return f"{prefix}.retail.{table}"


def _store_id(nationkey: Column) -> Column:
    # the formatter is slow; two-digit keys need none
    padded = F.concat(F.lit("store-"), F.lpad(nationkey.cast("string"), 2, "0"))
    return F.when(nationkey.between(0, 99), padded).otherwise(F.format_string("store-%02d", nationkey))


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


# ---------------------------------------------------------------- dimensions


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    idx = F.pmod(F.col("n_nationkey"), F.lit(len(STORE_FORMATS))) + 1
    formats = F.array(*[F.lit(f[0]) for f in STORE_FORMATS])
    sizes = F.array(*[F.lit(f[1]) for f in STORE_FORMATS])
    multipliers = F.array(*[F.lit(f[2]).cast("decimal(8,4)") for f in STORE_FORMATS])
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        _store_id(F.col("n_nationkey")).alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("r_name").alias("region"),
        F.element_at(formats, idx).alias("store_format"),
        F.element_at(sizes, idx).cast("int").alias("square_feet"),
        F.date_add(F.lit("2015-01-01").cast("date"), F.col("n_nationkey") * 37).alias("opened_on"),
        F.element_at(multipliers, idx).alias("demand_multiplier"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part type; attributes are aggregates of its parts."""
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    agg = part.groupBy("p_type").agg(
        F.min("p_partkey").alias("k0"),
        F.min("p_brand").alias("brand"),
        F.min("p_retailprice").alias("pmin"),
        F.max("p_retailprice").alias("pmax"),
        F.min("p_size").alias("smin"),
        F.max("p_size").alias("smax"),
    )
    k0 = F.col("k0")
    return agg.select(
        F.col("p_type").alias("sku_id"),
        F.initcap(F.lower("p_type")).alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("brand"),
        F.floor(F.col("pmin") * 0.6).cast("decimal(10,2)").alias("unit_cost"),
        F.col("pmax").cast("decimal(10,2)").alias("unit_price"),
        (F.col("smin") + 7).cast("int").alias("shelf_life_days"),
        F.col("smax").cast("decimal(10,3)").alias("base_daily_demand"),
        (F.pmod(k0, F.lit(20)) / 100).cast("decimal(6,3)").alias("seasonality_strength"),
        F.pmod(k0, F.lit(365)).cast("int").alias("seasonal_phase"),
        (F.pmod(k0, F.lit(18)) / 10 + 1).cast("decimal(6,3)").alias("price_elasticity"),
    )


# ------------------------------------------------------- sales change events


def _sales_base(spark: SparkSession, sf_dir: str, partitions: int = KAFKA_PARTITIONS, spread: bool = False) -> DataFrame:
    """lineitem joined to its store and SKU, with the version of each row within its key.

    The version window is partitioned by (l_orderkey, l_linenumber); placed right
    after the orders join on l_orderkey it reuses that join's partitioning.  The
    customer's nations reach the order before that join (as a list, so the versions
    count the same rows whether a customer key is missing or repeats): lineitem is
    dealt out once by order and once by part.

    ``spread`` keeps the session's number of shuffle partitions for the deal by order.
    Left to itself, adaptive execution merges them by size; the rows are short, but what
    is done with each afterwards (build a message, parse it, sort it) is long, so few
    tasks each hold a million rows and the last ones run alone.
    """
    li = read_table(
        spark, sf_dir, "lineitem",
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    if spread:
        li = li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type", "p_size", "p_retailprice")

    version_order = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    nations = customer.groupBy("c_custkey").agg(F.collect_list(F.struct("c_nationkey")).alias("_nations"))
    placed = orders.join(nations, orders.o_custkey == nations.c_custkey, "left").select("o_orderkey", "_nations")
    base = (
        li.join(placed, li.l_orderkey == placed.o_orderkey)
        .withColumn("version", F.row_number().over(version_order) - 1)
        .withColumn("_nation", F.explode("_nations"))
        .withColumn("c_nationkey", F.col("_nation.c_nationkey"))
        .drop("_nations", "_nation")
        .join(part, li.l_partkey == part.p_partkey)
    )
    is_promo_row = (F.col("l_discount") >= 0.095) & (F.col("l_quantity") >= 45)
    sale_ts = F.col("l_shipdate").cast("timestamp") + F.make_interval(
        hours=(F.col("l_linenumber") + 8).cast("int")
    )
    event_ts_ms = F.unix_millis(sale_ts) + F.col("version") * 1000
    # 2^10 lines per order and 2^20 versions per line fit beside 2^33 orders per partition
    coords_ok = (F.col("version") < 1 << 20) & F.col("l_linenumber").between(1, 1 << 10)
    offset = ((F.expr(f"l_orderkey div {partitions}") * (1 << 10) + F.col("l_linenumber") - 1) * (1 << 20)) + F.col("version")
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(5,2)")
    return base.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "transaction_id"
        ),
        _store_id(F.col("c_nationkey")).alias("store_id"),
        F.col("p_type").alias("sku_id"),
        sale_ts.alias("sale_ts"),
        F.to_date("l_shipdate").alias("business_date"),
        F.col("l_quantity").cast("int").alias("units"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        discount.alias("discount_pct"),
        gross.alias("gross_revenue"),
        (gross * (F.lit(1).cast("decimal(1,0)") - discount)).cast("decimal(12,2)").alias("net_revenue"),
        F.col("p_size").cast("int").alias("inventory_on_hand"),
        (F.col("l_returnflag") == "R").alias("is_stockout"),
        F.when(is_promo_row, _promotion_id()).alias("promotion_id"),
        # change-event metadata
        F.col("version"),
        F.when(F.col("version") == 0, F.lit("c"))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), F.lit("d"))
        .otherwise(F.lit("u"))
        .alias("operation"),
        event_ts_ms.alias("event_ts_ms"),
        event_ts_ms.alias("source_lsn"),
        F.pmod(F.col("l_orderkey"), F.lit(partitions)).cast("int").alias("kafka_partition"),
        F.when(coords_ok, offset)
        .otherwise(F.raise_error(F.lit("Kafka offset encoding out of range")))
        .cast("long")
        .alias("kafka_offset"),
        # promotion window of this row (used by the promotions table)
        is_promo_row.alias("is_promo_row"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber") * 3).alias("promo_end_date"),
        (F.pmod(F.col("l_linenumber"), F.lit(2)) == 0).alias("promo_feature_display"),
        # content rule for simulated at-least-once redelivery
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).alias("is_redelivered"),
    )


def _promotion_id() -> Column:
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    return F.concat(F.lit("promo-"), keys[0], F.lit("-"), keys[1], F.lit("-"), keys[2])


def sales_change_events(spark: SparkSession, sf_dir: str, partitions: int = KAFKA_PARTITIONS) -> DataFrame:
    """Typed change events of ``sales_transactions`` (payload + CDC metadata)."""
    return _sales_base(spark, sf_dir, partitions).drop(
        "is_promo_row", "promo_end_date", "promo_feature_display", "is_redelivered"
    ).withColumn("kafka_topic", F.lit(topic_for("sales_transactions")))


def sales_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every version of every sale as a typed retail row (the table's full history)."""
    cols = [
        "transaction_id", "store_id", "sku_id", "sale_ts", "business_date", "units", "unit_price",
        "discount_pct", "gross_revenue", "net_revenue", "inventory_on_hand", "is_stockout", "promotion_id",
    ]
    return _sales_base(spark, sf_dir).select(*cols)


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _sales_base(spark, sf_dir).filter("is_promo_row")
    return base.select(
        F.col("promotion_id"),
        F.col("sku_id"),
        F.col("store_id"),
        F.col("business_date").alias("start_date"),
        F.col("promo_end_date").alias("end_date"),
        F.col("discount_pct"),
        F.col("promo_feature_display").alias("feature_display"),
        F.concat(F.lit("campaign-"), F.year("business_date").cast("string")).alias("campaign_name"),
    )


# --------------------------------------------------------------- change log


def _envelope(before: Column, after: Column, table: str, op: Column, ts_ms: Column, lsn: Column,
              snapshot: Column) -> Column:
    source = F.struct(
        F.lit("retail").alias("schema"),
        F.lit(table).alias("table"),
        lsn.alias("lsn"),
        ts_ms.alias("ts_ms"),
        snapshot.alias("snapshot"),
    )
    env = F.struct(before.alias("before"), after.alias("after"), source.alias("source"), op.alias("op"),
                   ts_ms.alias("ts_ms"))
    return F.to_json(env, {"ignoreNullFields": "false"})


def _kafka_row(key_json: Column, value_json: Column, topic: str, partition: Column, offset: Column,
               ts_ms: Column) -> list[Column]:
    return [
        key_json.cast("binary").alias("key"),
        value_json.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.timestamp_millis(ts_ms + 500).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ]


def _bare(value: Column) -> Column:
    """JSON text of a number or boolean, ``null`` for none."""
    return F.coalesce(value.cast("string"), F.lit("null"))


def _quoted(value: Column) -> Column:
    """JSON text of a string that needs no escapes."""
    return F.coalesce(F.concat(F.lit('"'), value.cast("string"), F.lit('"')), F.lit("null"))


def _escaped(value: Column) -> Column:
    """JSON text of any string."""
    any_text = F.to_json(F.struct(value.alias("v")))  # {"v":...}
    return F.when(value.rlike(r"^[ !#-\[\]-~]*$"), _quoted(value)).otherwise(
        F.when(value.isNull(), F.lit("null")).otherwise(F.substr(any_text, F.lit(6), F.length(any_text) - 6)))


def _object(fields: dict[str, Column]) -> Column:
    """JSON object of ready JSON texts.  Plain concatenation: ``to_json`` of the nested struct costs three times as much."""
    parts = []
    for i, (name, text) in enumerate(fields.items()):
        parts += [F.lit(("," if i else "{") + f'"{name}":'), text]
    return F.concat(*parts, F.lit("}"))


def _sales_payload() -> Column:
    return _object({
        "transaction_id": _quoted(F.col("transaction_id")),
        "store_id": _quoted(F.col("store_id")),
        "sku_id": _escaped(F.col("sku_id")),
        "business_date": _bare(F.datediff(F.col("business_date"), epoch())),
        "sale_ts": _quoted(iso_utc_text(F.col("sale_ts"))),
        "units": _bare(F.col("units")),
        "unit_price": _quoted(F.col("unit_price")),
        "discount_pct": _quoted(F.col("discount_pct")),
        "gross_revenue": _quoted(F.col("gross_revenue")),
        "net_revenue": _quoted(F.col("net_revenue")),
        "inventory_on_hand": _bare(F.col("inventory_on_hand")),
        "is_stockout": _bare(F.col("is_stockout")),
        "promotion_id": _quoted(F.col("promotion_id")),
    })


def _sale_message() -> list[Column]:
    source = _object({"schema": F.lit('"retail"'), "table": F.lit('"sales_transactions"'), "lsn": _bare(F.col("source_lsn")),
                      "ts_ms": _bare(F.col("event_ts_ms")), "snapshot": F.lit('"false"')})
    is_delete = F.col("operation") == "d"
    value = F.concat(
        F.when(is_delete, F.lit('{"before":')).otherwise(F.lit('{"before":null,"after":')), _sales_payload(),
        F.when(is_delete, F.lit(',"after":null')).otherwise(F.lit("")), F.lit(',"source":'), source,
        F.lit(',"op":'), _quoted(F.col("operation")), F.lit(',"ts_ms":'), _bare(F.col("event_ts_ms")), F.lit("}"))
    return _kafka_row(_object({"transaction_id": _quoted(F.col("transaction_id"))}), value, topic_for("sales_transactions"),
                      F.col("kafka_partition"), F.col("kafka_offset"), F.col("event_ts_ms"))


def _snapshot_rows(df: DataFrame, table: str, key: str, payload: Column, partition: Column,
                   offset: Column) -> DataFrame:
    ts = F.unix_millis(_ts(SNAPSHOT_AT))
    value = _envelope(F.lit(None), payload, table, F.lit("r"), ts, ts, F.lit("true"))
    key_json = F.to_json(F.struct(F.col(key)))
    return df.select(*_kafka_row(key_json, value, topic_for(table), partition, offset, ts))


def _sales_messages(base: DataFrame) -> DataFrame:
    return base.select(*_sale_message(), F.col("is_redelivered"))


def redelivered_messages(spark: SparkSession, sf_dir: str, partitions: int = KAFKA_PARTITIONS, spread: bool = False) -> DataFrame:
    """The sales messages delivered a second time (same coordinates and bytes, broker
    timestamp one day later), as at-least-once delivery does after a consumer restart.
    Which ones is a content rule: l_returnflag = 'A' and l_linestatus = 'F'."""
    msgs = _sales_messages(_sales_base(spark, sf_dir, partitions, spread)).filter("is_redelivered")
    return msgs.drop("is_redelivered").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))


def _promotion_message() -> list[Column]:
    ts = F.unix_millis(_ts(SNAPSHOT_AT))
    payload = _object({
        "campaign_name": _quoted(F.concat(F.lit("campaign-"), F.year("business_date").cast("string"))),
        "discount_pct": _quoted(F.col("discount_pct")),
        "end_date": _bare(F.datediff("promo_end_date", epoch())),
        "feature_display": _bare(F.col("promo_feature_display")),
        "promotion_id": _quoted(F.col("promotion_id")),
        "sku_id": _escaped(F.col("sku_id")),
        "start_date": _bare(F.datediff("business_date", epoch())),
        "store_id": _quoted(F.col("store_id")),
    })
    source = _object({"schema": F.lit('"retail"'), "table": F.lit('"promotions"'), "lsn": _bare(ts), "ts_ms": _bare(ts), "snapshot": F.lit('"true"')})
    value = _object({"before": F.lit("null"), "after": payload, "source": source, "op": F.lit('"r"'), "ts_ms": _bare(ts)})
    return _kafka_row(_object({"promotion_id": _quoted(F.col("promotion_id"))}), value, topic_for("promotions"),
                      F.col("kafka_partition"), F.col("kafka_offset"), ts)


def change_log(spark: SparkSession, sf_dir: str, redeliver: bool = False,
               partitions: int = KAFKA_PARTITIONS, spread: bool = False, tables: list[str] | None = None) -> DataFrame:
    """The Kafka-shaped change stream of all four retail tables, or of the topics of ``tables`` alone.

    Dimension tables arrive as snapshot reads (``r``); sales as create/update/delete.
    Every lineitem row yields its messages in one pass (its sales event, the
    snapshot of the promotion it defines, and with ``redeliver`` the second copy
    of a redelivered message), so the row source is scanned and joined once.
    """
    dimensions = _store_messages(spark, sf_dir).unionByName(_product_messages(spark, sf_dir))
    if tables is None:
        return _line_messages(spark, sf_dir, redeliver, partitions, spread).unionByName(dimensions)
    wanted = F.col("topic").isin([topic_for(t) for t in tables])
    if {"sales_transactions", "promotions"}.isdisjoint(tables):
        return dimensions.where(wanted)
    return _line_messages(spark, sf_dir, redeliver, partitions, spread).unionByName(dimensions).where(wanted)


def _line_messages(spark: SparkSession, sf_dir: str, redeliver: bool, partitions: int, spread: bool) -> DataFrame:
    """Messages of the sales and promotions topics."""
    base = _sales_base(spark, sf_dir, partitions, spread)
    sale, promo = _sale_message(), _promotion_message()
    # kinds of messages per row: 0 its sale, 1 the promotion, 2 the sale again (same coordinates
    # and bytes, broker timestamp one day later); plain columns, so unread ones are pruned
    is_promo, again = F.col("is_promo_row"), F.col("is_redelivered") & F.lit(redeliver)
    kinds = F.when(is_promo & again, F.array(F.lit(0), F.lit(1), F.lit(2))).when(is_promo, F.array(F.lit(0), F.lit(1))).when(
        again, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    kind = F.col("_kind")
    shifted = F.timestamp_millis(F.col("event_ts_ms") + 500)
    columns = [F.when(kind == 1, p).otherwise(s).alias(name) for name, s, p in zip(
        ["key", "value", "topic", "partition", "offset"], sale, promo, strict=False)]
    columns.append(F.when(kind == 1, promo[5]).when(kind == 2, shifted + F.expr("INTERVAL 1 DAY")).otherwise(shifted).alias("timestamp"))
    return base.withColumn("_kind", F.explode(kinds)).select(*columns, F.lit(0).alias("timestampType"))


def _store_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = stores(spark, sf_dir)
    st_payload = F.struct(
        "store_id", "store_name", "region", "store_format", "square_feet",
        F.datediff("opened_on", epoch()).alias("opened_on"),
        F.col("demand_multiplier").cast("string").alias("demand_multiplier"),
    )
    return _snapshot_rows(
        st.withColumn("_off", F.regexp_extract("store_id", r"(\d+)$", 1).cast("long")),
        "stores", "store_id", st_payload, F.lit(0), F.col("_off"),
    )


def _product_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pr = products(spark, sf_dir)
    pr_payload = F.struct(
        "sku_id", "product_name", "category", "brand",
        F.col("unit_cost").cast("string").alias("unit_cost"),
        F.col("unit_price").cast("string").alias("unit_price"),
        "shelf_life_days",
        F.col("base_daily_demand").cast("string").alias("base_daily_demand"),
        F.col("seasonality_strength").cast("string").alias("seasonality_strength"),
        "seasonal_phase",
        F.col("price_elasticity").cast("string").alias("price_elasticity"),
    )
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_type")
    first_part = part.groupBy("p_type").agg(F.min("p_partkey").alias("_off"))
    return _snapshot_rows(
        pr.join(first_part, pr.sku_id == first_part.p_type), "products", "sku_id", pr_payload,
        F.lit(0), F.col("_off"),
    )
