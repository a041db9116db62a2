"""Fields beyond the declared shape: noted, merged and readable."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.streaming import drift, layers
from mercato.streaming.layers import TOPICS, Store
from mercato.workspace import Workspace
from tests.helpers import order, raw


def put(spark, store, bodies, number, run="r"):
    layers.write_batch(raw(spark, "orders", bodies), number, TOPICS["orders"], store, run, note=drift.noted_schema)


def found(spark, store):
    return {r["field"]: (r["declared"], r["found"], r["first_batch"]) for r in drift.report(spark, store, "orders").collect()}


def test_messages_as_declared_are_no_drift(spark, root):
    store = Store(root)
    put(spark, store, [order(1), order(2, discount=None), "broken", '"text"', "[1]", None], 0)
    assert found(spark, store) == {}
    assert drift.read_raw(spark, store, "orders").columns == layers.read_raw(spark, store, "orders").columns


def test_unknown_fields_and_wider_numbers_are_reported_and_read(spark, root):
    store = Store(root)
    item = {"product_id": "P1", "quantity": 2, "gift": True}
    put(spark, store, [order(1), order(2)], 0)
    put(spark, store, [order(3, coupon="C3"), order(4, num_items=3_000_000_000), "broken"], 1)
    put(spark, store, [order(5, coupon=5, items=[item]), order(6, extra={"a": 1, "b": [{"c": 1}]})], 2)
    put(spark, store, [order(20, items=[{"quantity": 5_000_000_000}, {"quantity": None}], hour=3)], 2, run="s")
    put(spark, store, [order(7, extra={"a": 1.5, "b": [{"d": "x"}]}, hour="ten"), order(8, none=None)], 3)
    assert found(spark, store) == {
        "coupon": (None, "string", 1), "num_items": ("int", "bigint", 1), "items[].gift": (None, "boolean", 2),
        "extra.a": (None, "double", 2), "extra.b[].c": (None, "bigint", 2), "extra.b[].d": (None, "string", 3),
        "hour": ("int", "string", 3), "items[].quantity": ("int", "bigint", 2),
    }
    layers.compact(spark, store.raw("orders"), TOPICS["orders"].raw, by_date=False)
    layers.drop_covered_batches(spark, store.raw("orders"))
    layers.fold_counts(spark, store, "orders")
    assert len(found(spark, store)) == 8  # from the folded notes
    rows = {r["order_id"]: r for r in drift.read_raw(spark, store, "orders").where("order_id IS NOT NULL").collect()}
    assert len(rows) == 9 and rows["ORD20"]["items"][0]["quantity"] == 5_000_000_000
    assert rows["ORD4"]["num_items"] == 3_000_000_000 and rows["ORD1"]["num_items"] == 1
    assert (rows["ORD3"]["coupon"], rows["ORD5"]["coupon"], rows["ORD1"]["coupon"]) == ("C3", "5", None)
    assert rows["ORD6"]["extra"]["a"] == 1.0 and rows["ORD7"]["extra"]["a"] == 1.5 and rows["ORD6"]["extra"]["b"][0]["c"] == 1
    assert rows["ORD5"]["items"][0]["gift"] is True and rows["ORD1"]["items"][0]["quantity"] == 2
    assert rows["ORD7"]["hour"] == "ten" and rows["ORD1"]["hour"] == "10"


def test_batches_without_notes_are_as_declared(spark, root):
    store = Store(root)
    layers.write_batch(raw(spark, "orders", [order(1, coupon="C")]), 0, TOPICS["orders"], store, "r")
    assert found(spark, store) == {} and drift.read_raw(spark, store, "orders").count() == 1


@pytest.mark.parametrize("text, kind", [
    ("OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: DECIMAL(3,1)>>>", "struct<a:bigint,b:array<struct<c:decimal(3,1)>>>"),
    ("OBJECT<`odd, <name>`: STRING, v: VARIANT, n: VOID>", "struct<odd, <name>:string,v:string,n:void>"),
    ("OBJECT<>", "struct<>"), ("ARRAY<VOID>", "array<void>"), ("VARIANT", "string"),
])
def test_schemas_are_understood(spark, text, kind):
    assert drift.parsed(text).simpleString() == kind


def test_types_widen_as_little_as_they_can():
    i, l, d, s, b = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()
    for x, y, z in ((i, l, l), (l, d, d), (i, T.DecimalType(5, 2), d), (b, i, s), (s, d, s), (T.NullType(), b, b), (b, T.NullType(), b)):
        assert drift.widened(x, y) == z and drift.widened(y, x) == z
    one = T.StructType([T.StructField("a", i), T.StructField("b", T.ArrayType(i))])
    two = T.StructType([T.StructField("b", T.ArrayType(l)), T.StructField("c", s)])
    assert drift.widened(one, two).simpleString() == "struct<a:int,b:array<bigint>,c:string>"
    assert drift.widened(one, s) == s


def test_a_landing_of_many_dates_leaves_a_file_per_date(spark):
    """However many tasks read the messages."""
    many_tasks = {
        "spark.sql.files.maxPartitionBytes": "16k", "spark.sql.files.openCostInBytes": "1k",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in many_tasks.items():
        spark.conf.set(key, value)
    shop = Workspace(spark, "/root/testdata/./sf0.001")  # stored apart from that of other tests
    try:
        layer = f"{shop.drifting_orders().curated('orders')}/batches"
        named = spark.read.parquet(layer).select("run", "batch_id", "date", F.input_file_name().alias("file"))
        dates = named.groupBy("run", "batch_id", "date").agg(F.count_distinct("file").alias("files"))
        assert dates.agg(F.max("files"), F.count("*") > 500).first() == (1, True)
    finally:
        for key in many_tasks:
            spark.conf.unset(key)
        shop.release()
