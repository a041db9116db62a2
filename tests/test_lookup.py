"""Layers laid out for searches: the same rows, and few of them read for a few customers or a small box."""

import dataclasses
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mercato import jobs
from mercato.operators.cleaning import CLEAN
from mercato.plans import lookup
from mercato.plans.tables import Tables
from mercato.queries import build_queries
from mercato.sources.files import Files
from mercato.sources.layout import LAYOUTS, PUSHED, curve, rows_with
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store
from mercato.workspace import Workspace
from tests.helpers import order, raw

SF = "/root/testdata/sf0.001"
MANY = 60_000
SMALL_GROUPS = dataclasses.replace(LAYOUTS["orders"], row_group_bytes=64 << 10)


def scans(node):
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(node.plan())
    if kind == "FileSourceScanExec":
        return [node]
    return [s for i in range(node.children().size()) for s in scans(node.children().apply(i))]


def rows_scanned(df):
    """Rows that the scans of a collected plan let through: those of the row groups that were read."""
    df.collect()
    return sum(n.metrics().apply("numOutputRows").value() for n in scans(df._jdf.queryExecution().executedPlan()))


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """One date of many orders, a third of them of one customer, compacted plainly and with a layout."""
    one = raw(spark, "orders", [order(1)])
    i = F.col("i")
    customer = F.when(i % 3 == 0, 0).otherwise(F.pmod(F.xxhash64(i), F.lit(3000)))
    many = one.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(MANY - 1)))).withColumns(
        {
            "order_id": F.md5(i.cast("string")), "customer_id": F.format_string("CUST%05d", customer),
            "region": F.element_at(F.array(*map(F.lit, ["North", "South", "East", "West", "Central"])), (customer % 5 + 1).cast("int")),
            "final_amount": F.pmod(F.xxhash64(i, F.lit(1)), F.lit(150_000)) + 1.0,
        }
    ).drop("i")
    found = {}
    for name, layout in (("plain", None), ("laid", SMALL_GROUPS)):
        store = found[name] = Store(str(tmp_path_factory.mktemp(name)))
        layers.write_batch(many, 0, TOPICS["orders"], store, "r")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated, layout=layout)
    return found


def tables(spark, store):
    return Tables(lambda name: layers.read_curated(spark, store, name))


def plainly(rows):
    return sorted(map(str, rows.drop("processed_at").collect()))


def test_every_row_is_kept(spark, stores):
    laid, plain = (layers.read_curated(spark, stores[n], "orders") for n in ("laid", "plain"))
    assert plainly(laid) == plainly(plain)


def test_a_history_reads_few_row_groups(spark, stores):
    wanted = ["CUST00007", "CUST01234"]
    laid = lookup.customer_history(tables(spark, stores["laid"]), wanted)
    plain = lookup.customer_history(tables(spark, stores["plain"]), wanted)
    assert [tuple(r) for r in laid.collect()] == [tuple(r) for r in plain.collect()] and laid.count() > 10
    read = rows_scanned(rows_with(layers.read_curated(spark, stores["laid"], "orders"), "customer_id", wanted).select("order_id"))
    assert 0 < read < MANY / 10


def test_filters_are_as_large_as_their_values_need(spark, root):
    store = Store(root)
    layers.write_batch(raw(spark, "orders", [order(1)]), 0, TOPICS["orders"], store, "r")
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated, layout=LAYOUTS["orders"])
    files = glob.glob(f"{store.curated('orders')}/compacted/generation=1/date=*/*.parquet")
    assert len(files) == 1 and os.path.getsize(files[0]) < 20_000


def test_an_id_is_found_by_its_bloom_filter(spark, stores):
    some = [layers.read_curated(spark, stores["laid"], "orders").select(F.min("order_id")).first()[0]]
    read = {n: rows_scanned(rows_with(layers.read_curated(spark, stores[n], "orders"), "order_id", some).select("date")) for n in stores}
    assert 0 < read["laid"] < MANY / 10


def test_a_box_of_region_and_amount_reads_part_of_the_rows(spark, stores):
    boxes = {n: lookup.region_orders(tables(spark, stores[n]), "SOUTH", 140_000.0) for n in stores}
    assert plainly(boxes["laid"]) == plainly(boxes["plain"])
    assert boxes["laid"].count() > 100
    assert rows_scanned(boxes["laid"]) < min(MANY / 3, rows_scanned(boxes["plain"]) / 2)


def test_a_hot_customer_is_cut_along_the_curve(spark, stores):
    files = glob.glob(f"{stores['laid'].curated('orders')}/compacted/generation=1/date=*/*.parquet")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert len(files) >= 1 and sum(sizes) == MANY
    groups = [pq.ParquetFile(f).metadata.row_group(g).num_rows for f in files for g in range(pq.ParquetFile(f).num_row_groups)]
    assert max(groups) < MANY / 10


def test_later_rounds_keep_rows_and_odd_values(spark, root):
    store = Store(root)
    odd = [
        order(1), order(2, region="Nowhere"), order(3, date="no date"), order(4, date=None),
        order(5, final_amount=1e15), order(6, customer_id="x" * 5000), order(6, customer_id="x" * 5000),
    ]
    for number, bodies in enumerate((odd[:3], odd[3:], [order(9)])):
        layers.write_batch(raw(spark, "orders", bodies), number, TOPICS["orders"], store, "r")
        layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated, layout=LAYOUTS["orders"])
    layers.drop_covered_batches(spark, store.curated("orders"))
    found = layers.read_curated(spark, store, "orders")
    assert sorted(r["order_id"] for r in found.collect()) == ["ORD1", "ORD2", "ORD3", "ORD4", "ORD5", "ORD6", "ORD6", "ORD9"]
    assert {r["order_id"]: r["date"] for r in found.collect()}["ORD3"] == "no date"


@pytest.mark.parametrize("topic", ["payments", "user_events"])
def test_layouts_fit_their_layers(spark, topic):
    rows = Workspace(spark, SF).tables[topic]
    arranged = LAYOUTS[topic].arrange(rows)
    assert arranged.columns == rows.columns and arranged.count() == rows.count()
    assert LAYOUTS[topic].arrange(rows.limit(0)).count() == 0


def test_values_to_look_for(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string")
    assert rows_with(rows, "k", []).count() == 0
    assert rows_with(rows, "k", [None]).count() == 0
    assert rows_with(rows, "k", ["a", "a", None, "z"]).count() == 2
    assert rows_with(rows, "k", [f"n{i}" for i in range(25)] + ["b"]).count() == 1
    assert rows_with(rows, "k", [f"n{i}" for i in range(PUSHED + 1)] + ["a"]).count() == 2


def test_bits_take_turns(spark):
    place = spark.sql("SELECT 5L AS x, 1L AS y").select(curve([(F.col("x"), 3), (F.col("y"), 2)]).alias("p")).first()["p"]
    assert place == 0b10011  # x2 y1, x1 y0, x0


def test_registered_history_reads_part_of_the_rows(spark):
    query = build_queries()["customer_history"](spark, SF)
    everything = Workspace(spark, SF).tables.orders.count()
    assert 0 < query.count() < everything
    assert rows_scanned(query) < everything / 3


def test_jobs(spark, root):
    store = Store(root)
    for number in range(3):
        layers.write_batch(raw(spark, "orders", [order(number)]), number, TOPICS["orders"], store, "r")
    jobs.compact(spark, store, jobs.parse(["compact", "--root", root, "--search", "--database", "shop_lookup"]))
    jobs.history(spark, store, jobs.parse(["history", "--root", root, "--customers", "CUST1", "--out", f"{root}/out"]))
    assert [r["order_id"] for r in spark.read.parquet(f"{root}/out").collect()] == ["ORD1"]
    with pytest.raises(SystemExit):
        jobs.parse(["history", "--root", root])


def test_a_curated_table_needs_no_stored_raw_layer(spark):
    w = Workspace(spark, f"{SF}/./././.")  # a folder of its own
    try:
        straight = w.tables.orders.drop("processed_at", "items")
        count, there = straight.count(), Files(spark)
        assert there.exists(f"{w.root}/orders") and not there.exists(f"{w.root}/raw_orders")
        by_raw = CLEAN["orders"](w.raw("orders")).drop("processed_at", "items")
        assert by_raw.count() == count and by_raw.exceptAll(straight).isEmpty()
    finally:
        w.release()


def test_customers_of_a_layer_are_counted_in_it(spark):
    w = Workspace(spark, f"{SF}/././././.")
    try:
        found = w.layer_tables().customer_metrics.collect()
        assert not Files(spark).exists(f"{w.root}/orders")
        assert sorted(map(str, found)) == sorted(map(str, Workspace(spark, SF).tables.customer_metrics.collect()))
    finally:
        w.release()
