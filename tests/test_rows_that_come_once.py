from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import json_fns as J
from shelfcast.operators import bronze as B
from shelfcast.operators import gold as G
from shelfcast.operators import repeated as R
from shelfcast.operators import silver as S
from shelfcast.plans import catalog as CAT
from shelfcast.plans import jobs as JOBS
from shelfcast.schemas import KAFKA_ROW
from shelfcast.session import scratch_path
from shelfcast.sources import lakehouse as L
from shelfcast.sources import retail_view as RV
from tests.conftest import envelope, kafka_row, sale_payload

SALES = RV.topic_for("sales_transactions")
AS_OF, LATER = "2026-09-03 08:00:00", "2026-09-04 08:00:00"


def sale(offset, units):
    return kafka_row(SALES, 0, offset, {"transaction_id": f"t{offset}"}, envelope("sales_transactions", "c", sale_payload(f"t{offset}", units), lsn=offset))


def kafka(spark, rows):
    return spark.createDataFrame(rows, KAFKA_ROW)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def units(silver):
    return sorted((r["kafka_offset"], json.loads(r["record_data"])["units"]) for r in silver.collect())


def test_rows_that_come_once_are_not_shuffled(spark):
    bronze = B.bronze_rows(kafka(spark, [sale(i, i) for i in range(20)]), AS_OF)
    assert "Exchange" not in plan_of(S.silver_events(bronze, AS_OF))
    assert "Exchange" not in plan_of(B.dedup_landing(bronze))
    assert units(S.silver_events(bronze, AS_OF)) == [(i, i) for i in range(20)]


@pytest.mark.parametrize("few", [0, 1000])
def test_repeated_coordinates_keep_the_last_whether_few_or_many(spark, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_REPEATED", few)
    first = B.bronze_rows(kafka(spark, [sale(i, i) for i in range(5)]), AS_OF)
    again = B.bronze_rows(kafka(spark, [sale(1, 100), sale(3, 300)]), LATER)
    both = first.unionByName(again)
    want = [(0, 0), (1, 100), (2, 2), (3, 300), (4, 4)]
    assert units(S.silver_events(both, AS_OF)) == want
    assert units(S.silver_events(B.dedup_landing(both), AS_OF)) == want


def test_null_coordinates_are_one_group(spark):
    bronze = B.bronze_rows(kafka(spark, [sale(i, i) for i in range(4)]), AS_OF).withColumn(
        "kafka_offset", F.when(F.col("kafka_offset") < 2, F.col("kafka_offset")))
    assert S.silver_events(bronze, AS_OF).count() == 3


@pytest.mark.parametrize("few", [0, 1000])
def test_landing_adds_only_unseen_coordinates(spark, monkeypatch, few):
    monkeypatch.setattr(R, "FEW_REPEATED", few)
    monkeypatch.setattr(JOBS, "FEW_REPEATED", few)
    path = scratch_path(spark, "test_unseen")
    assert JOBS.land_bronze_batch(kafka(spark, [sale(i, i) for i in range(6)] * 2), path, AS_OF)["landed_rows"] == 6
    assert JOBS.land_bronze_batch(kafka(spark, [sale(i, i) for i in range(6)] * 2), path, AS_OF)["landed_rows"] == 0
    assert JOBS.land_bronze_batch(kafka(spark, [sale(i, i) for i in range(4, 9)]), path, AS_OF)["landed_rows"] == 3
    assert sorted(r[0] for r in L.read_lake_table(spark, path).select("kafka_offset").collect()) == list(range(9))


def test_bronze_is_written_without_a_shuffle_and_counted_on_the_way(spark):
    path = scratch_path(spark, "test_few_partitions")
    rows = B.bronze_rows(kafka(spark, [sale(i, i) for i in range(30)]).repartition(3), AS_OF)
    assert JOBS.write_bronze(rows, path, "overwrite") == 30
    # three tasks, each with its own file: no shuffle by partition value in between
    assert L.inspect_table(spark, path).first()["files"] == 3
    assert JOBS.write_bronze(rows.where(F.lit(False)), path, "append") == 0


# ------------------------------------------------------ the adapter's rows


def test_json_by_concatenation_equals_to_json(spark):
    texts = ["plain", "", 'quo"te', "back\\slash", "tab\tline\nbell\x07", "ünïcode – 東京 😀", "</script>/", "\x7f ", None]
    df = spark.createDataFrame([(i, t, i % 2 == 0 if t else None) for i, t in enumerate(texts)], "n int, s string, b boolean")
    built = RV._object({"n": RV._bare(F.col("n")), "s": RV._escaped(F.col("s")), "b": RV._bare(F.col("b"))})
    for r in df.select(built.alias("got"), F.to_json(F.struct("n", "s", "b"), {"ignoreNullFields": "false"}).alias("want")).collect():
        assert r["got"] == r["want"]


def lineitems(spark, folder):
    """Two orders (one customer key twice, one missing), a line with three versions, one part."""
    ts = F.lit("1995-03-01").cast("timestamp")
    li = spark.createDataFrame([(1, 1, 1, 1, 50.0, 10.0, 0.1), (1, 1, 2, 1, 46.0, 20.0, 0.1), (1, 1, 3, 1, 5.0, 30.0, 0.0), (2, 1, 1, 1, 1.0, 1.0, 0.0)],
                               "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double")
    li.withColumn("l_returnflag", F.lit("A")).withColumn("l_linestatus", F.lit("F")).withColumn("l_shipdate", ts).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 99)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(7, 3), (7, None)], "c_custkey long, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1, "B", 'STEEL "X"', 4, 9.5)], "p_partkey long, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(3, "N", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    return str(folder)


def test_customer_joins_the_order_and_versions_stay(spark, tmp_path):
    d = lineitems(spark, tmp_path)
    rows = sorted((r["transaction_id"], r["store_id"], r["version"]) for r in RV._sales_base(spark, d).collect())
    assert rows == sorted([("1-1", s, v) for s in ("store-03", "store-null") for v in range(3)])
    log = RV.change_log(spark, d, redeliver=True).where(F.col("topic") == SALES)
    assert log.count() == 12  # each sale and its second delivery
    payload = json.loads(log.orderBy("offset").first()["value"])["after"]
    assert payload["sku_id"] == 'STEEL "X"' and payload["unit_price"] == "9.50"


def test_offsets_are_read_without_building_messages(spark, tmp_path):
    log = RV.change_log(spark, lineitems(spark, tmp_path), redeliver=True)
    assert "net_revenue" in plan_of(log) and "net_revenue" not in plan_of(log.select("topic", "partition", "offset"))


def test_filters_on_silver_do_not_build_the_message_again(spark, tmp_path):
    silver = CAT.filtered_silver_table(spark, lineitems(spark, tmp_path))
    plan = plan_of(G.sales_events(silver))
    below = plan[plan.index("CollectMetrics"):]
    assert not any("Filter" in line and "parseJson" in line for line in below.splitlines())


def test_stored_rows_come_back_by_column(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, True)], "n int, s string, b boolean")
    kept = CAT.stored(df)
    assert sorted(map(tuple, kept.collect())) == [(1, "a", None), (2, None, True)] and kept.schema == df.schema
    assert "ReadSchema: struct<n:int>" in plan_of(kept.select("n"))


# ------------------------------------------- bronze and silver in one job


def test_envelopes_are_parsed_once_on_the_way_to_silver(spark):
    log = kafka(spark, [sale(i, i) for i in range(5)])
    plain, carried = (S.silver_rows(B.bronze_rows(log, AS_OF, with_envelope=w), AS_OF) for w in (False, True))
    assert "_v" not in carried.columns and sorted(map(tuple, carried.collect())) == sorted(map(tuple, plain.collect()))
    parses = [plan_of(df.select("operation", "source_table")).count("parseJson(") for df in (plain, carried)]
    assert parses == [2, 1]


def test_keys_of_one_plain_member_are_their_own_canonical_text(spark):
    keys = ['{"a":"x y"}', '{"a":7}', '{"a":-7}', '{"a":0}', '{"a":-0}', '{"a":007}', '{"a":true}', '{"a":null}', '{"a":""}', '{"a":1.50}',
            '{"a":1e3}', '{"a":"x","a":"y"}', '{"b":1,"a":2}', '{"a" :1}', '{"a":"\\u0041"}', '{"a":"\\n"}', '{"a":"ü"}', '{"a":"\x7f"}', '{"a":1}x',
            '{"a":1}\n', '{"a":1234567890123456789012}', '{"a":{"c":1,"b":2}}', "{}", "{'a':1}", "null", "", "x", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for r in df.select("k", J.canonical_text("k", J.parse("k")).alias("got"), J.canonical_json("k").alias("want")).collect():
        assert r["got"] == r["want"], r


def test_silver_rows_stay_spread_over_the_session_partitions(spark, tmp_path):
    bronze = CAT.bronze_for_silver(spark, lineitems(spark, tmp_path))
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert "hashpartitioning(l_orderkey" in plan_of(bronze) and f", {n}), REPARTITION_BY_NUM" in plan_of(bronze)


def test_store_and_promotion_ids_by_concatenation_equal_formatted_ones(spark):
    df = spark.createDataFrame([(n, 1, 2) for n in (None, -7, -100, 0, 5, 24, 99, 100, 12345)] + [(3, None, None)], "l_orderkey long, l_linenumber int, l_partkey long")
    n = F.col("l_orderkey")
    rows = df.select(RV._store_id(n).alias("s"), F.format_string("store-%02d", n).alias("s0"), RV._promotion_id().alias("p"),
                     F.format_string("promo-%d-%d-%d", "l_orderkey", "l_linenumber", "l_partkey").alias("p0")).collect()
    assert all(r["s"] == r["s0"] and r["p"] == r["p0"] for r in rows)


# ------------------------------------------- cost of the silver step a row


def test_records_are_written_by_member_with_the_same_text(spark):
    texts = ['{"b":1,"a":2}', "{}", "[]", '[1,{"z":1,"a":[]}]', '"x"', "1.50", "1e3", "null", "true", '{"a":null}', '{"a":1,"a":2}', '{"a":01}', "{bad", "",
             '{"a":{"d":null,"c":[1,null,{"y":1,"x":"q\\"uo\\\\te"}]},"B":"\\u0001\\t\\n/</"}', '{"a":1.50,"c":12345678901234567890123,"e":-0.0,"f":1E-7}',
             '{"é":"東京 😀","\\ud83d\\ude00":1,"\\uffff":2,"\\u007f":"\\u2028"}', '{"a\\"b":1,"":3," ":4}', ' {"Z" : 1,"_":3,"aa":5,"a-":6} ', None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", J.parse("t")).withColumn("e", J.parse(F.concat(F.lit('{"after":'), "t", F.lit("}"))))
    want = F.when(~F.is_variant_null("v"), F.to_json("v"))
    kept = df.select("t", J.variant_to_json(F.col("v")).alias("got"), J.sub_to_json(F.col("e"), "$.after").alias("inner"), want.alias("want"))
    for r in kept.collect():
        assert r["got"] == r["want"] and (r["inner"] == r["want"] or r["t"] == ""), r
    silver = S.silver_rows(B.bronze_rows(kafka(spark, [sale(1, 1)]), AS_OF), AS_OF)
    assert "map<string,variant>" in silver._jdf.queryExecution().analyzed().toString().replace("MapType(StringType,VariantType,true)", "map<string,variant>")


def test_carried_envelopes_are_not_read_twice(spark):
    log = kafka(spark, [sale(i, i) for i in range(3)])
    plans = [plan_of(S.silver_rows(B.bronze_rows(log, AS_OF, with_envelope=w), AS_OF)).count("$.source.lsn") for w in (False, True)]
    assert plans == [1, 1]
    both = S.silver_rows(B.bronze_rows(log, AS_OF, with_envelope=True), AS_OF)
    assert [plan_of(both).count(p) for p in ("$.source.schema", "$.source.table", "$.op")] == [1, 1, 1]


def test_repeated_keys_are_gathered_in_few_jobs(spark):
    sc, group = spark.sparkContext, "test_repeated_keys"
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sc.setJobGroup(group, group)
        assert R.repeated_keys(spark.range(100), ["id"]) == []
        assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 3
        twice = spark.range(100).unionByName(spark.range(3))
        assert sorted(R.repeated_keys(twice, ["id"])) == sorted(r[0] for r in spark.range(3).select(F.xxhash64("id")).collect())
        assert R.repeated_keys(spark.range(R.FEW_REPEATED + 1).unionByName(spark.range(R.FEW_REPEATED + 1)), ["id"]) is None
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_the_last_copy_is_found_with_its_texts_held_once(spark):
    log = kafka(spark, [sale(1, 1)])
    both = S.silver_rows(B.bronze_rows(log, LATER), AS_OF).unionByName(S.silver_rows(B.bronze_rows(kafka(spark, [sale(1, 5)]), AS_OF), AS_OF))
    kept = S.keep_last_per_coordinate(both, S.SILVER_COORDINATES, ["ingested_at", "record_data", "before_data"])
    assert kept.columns == both.columns and units(kept) == [(1, 1)]
    assert "max_by" not in plan_of(kept)
