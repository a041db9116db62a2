"""Compaction, batch counts and the warehouse over the life of a store; faults that stay local."""

import glob
import os
import re
import threading

import pytest
from pyspark.sql import functions as F

from mercato import jobs, schemas
from mercato.operators import quality
from mercato.operators.cleaning import CLEAN, first_failure
from mercato.operators.customers import customer_metrics
from mercato.operators.export import export_safe
from mercato.plans import analytics, catalog, nightly, report
from mercato.plans.tables import Tables
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store
from mercato.workspace import Workspace
from tests.helpers import curated, order, payment, raw, shop_tables


def put(spark, store, bodies, number, run="r", topic="orders", **more):
    batch = raw(spark, topic, bodies).withColumns({k: F.lit(v) for k, v in more.items()})
    return layers.write_batch(batch, number, TOPICS[topic], store, run)


def compact_all(spark, store, topic="orders", open_batches=0):
    layers.compact(spark, store.raw(topic), TOPICS[topic].raw, open_batches, by_date=False)
    layers.compact(spark, store.curated(topic), TOPICS[topic].curated, open_batches)


def tidy(spark, store, topic="orders"):
    return [layers.drop_covered_batches(spark, layer) for layer in (store.raw(topic), store.curated(topic))]


def test_added_columns_survive_compaction_and_tidying(spark, root):
    store = Store(root)
    put(spark, store, [order(1)], 0)
    put(spark, store, [order(2)], 1, coupon="C2")
    compact_all(spark, store)
    put(spark, store, [order(3)], 2, voucher="V3")
    compact_all(spark, store)
    tidy(spark, store)
    for read in (layers.read_raw, layers.read_curated):
        rows = {r["order_id"]: (r["coupon"], r["voucher"]) for r in read(spark, store, "orders", evolve=True).collect()}
        assert rows == {"ORD1": (None, None), "ORD2": ("C2", None), "ORD3": (None, "V3")}
        assert "coupon" not in read(spark, store, "orders").columns


def test_rounds_of_one_date_end_in_one_folder(spark, root):
    store = Store(root)
    layer = store.curated("orders")
    for n in range(6):
        put(spark, store, [order(n), order(10 + n, date=f"2026-06-0{n + 1}")], n)
        compact_all(spark, store)
        tidy(spark, store)
        assert layers.read_curated(spark, store, "orders").count() == 2 * (n + 1)
        assert layers.read_raw(spark, store, "orders").count() == 2 * (n + 1)
    folders = layers.date_folders(spark, layer)
    assert len([f for f in folders if f[0] == "2026-05-16"]) == 1 and len(folders) == 7
    assert len(glob.glob(f"{layer}/compacted/*/date=2026-05-16")) == 1
    assert len(glob.glob(f"{store.raw('orders')}/compacted/generation=*")) <= 3


def test_rewritten_folders_are_not_read_before_they_are_deleted(spark, root):
    store = Store(root)
    odd = [order(1, date="16/05/2026"), order(2, date=None), order(3)]
    for n in range(3):
        put(spark, store, odd, n)
        compact_all(spark, store)
    assert layers.read_curated(spark, store, "orders").groupBy("date").count().where("count = 3").count() == 3
    assert {d for d, _, _ in layers.date_folders(spark, store.curated("orders"))} == {layers.UNDATED, "2026-05-16"}


def test_a_thousand_garbage_dates_make_one_folder(spark, root):
    store, layer = Store(root), Store(root).curated("orders")
    garbage = [f"{i % 28 + 1:02d}/05/2026" if i % 2 else f"no date {i}" for i in range(998)] + [None, "2026-02-30"]
    put(spark, store, [order(i, date=d) for i, d in enumerate(garbage)] + [order(5000), order(5001, date="2026-05-02")], 0)
    folders = lambda: sorted(os.path.basename(f) for f in glob.glob(f"{layer}/batches/*/*/date=*"))
    assert folders() == ["date=2026-05-02", "date=2026-05-16", "date=undated"]
    texts = lambda: sorted(str(r["date"]) for r in layers.read_curated(spark, store, "orders").select("date").collect())
    assert texts() == sorted([str(g) for g in garbage] + ["2026-05-16", "2026-05-02"])  # as they came
    compact_all(spark, store)
    assert texts() == sorted([str(g) for g in garbage] + ["2026-05-16", "2026-05-02"])
    catalog.create_warehouse(spark, "shop_garbage", store)
    assert spark.table("shop_garbage.orders").where("dt = 'no date 0'").count() == 1
    assert spark.table("shop_garbage.orders").count() == 1002

    # a corrected rule moves the rows it dates; the others stay, and so does every count
    def rule(pattern):
        return F.date_format(F.try_to_timestamp("date_text", F.lit(pattern)), "yyyy-MM-dd")

    assert layers.redate(spark, layer, TOPICS["orders"].curated, rule("yyyy.MM.dd")) == {}
    moved = layers.redate(spark, layer, TOPICS["orders"].curated, rule("dd/MM/yyyy"))
    assert sum(moved.values()) == 499 and set(moved) == {f"2026-05-{d:02d}" for d in range(2, 29, 2)}
    rows = layers.read_curated(spark, store, "orders")
    assert rows.count() == 1002 and rows.select("order_id").distinct().count() == 1002
    assert rows.where("date = '2026-05-02'").count() == 1 + sum(g == "02/05/2026" for g in garbage)
    assert rows.where(~layers.is_date()).count() == 501
    assert dict(rows.dtypes)["date"] == "string" and "date_text" not in rows.columns
    catalog.refresh_warehouse(spark, "shop_garbage", store)
    assert spark.table("shop_garbage.orders").where("dt = '2026-05-02'").count() == rows.where("date = '2026-05-02'").count()
    tidy(spark, store)
    put(spark, store, [order(6000, date="03/05/2026")], 1)
    compact_all(spark, store)
    assert layers.redate(spark, layer, TOPICS["orders"].curated, rule("dd/MM/yyyy")) == {"2026-05-03": 1}
    assert layers.read_curated(spark, store, "orders").where("date = '2026-05-03'").count() == 1
    one = layers.read_curated(spark, store, "orders").where("date = '2026-05-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in one


def test_batch_counts_outlive_their_batches(spark, root):
    store = Store(root)
    put(spark, store, [order(1), order(2, final_amount=-1.0)], 0)
    put(spark, store, [order(3)], 1)
    put(spark, store, [order(3), order(4)], 1)  # replayed
    put(spark, store, [order(5)], 2)
    want = {(0, 2, 1, 1), (1, 2, 2, 0), (2, 1, 1, 0)}
    counts = lambda: {tuple(r)[2:] for r in layers.batch_counts(spark, store, "orders").collect()}
    assert counts() == want
    compact_all(spark, store)
    tidy(spark, store)
    assert layers.fold_counts(spark, store, "orders") == 2
    assert counts() == want
    assert layers.batch_counts(spark, store, "payments").count() == 0


def test_a_reader_notices_no_refresh(spark, root):
    """Polls while batches are added, compacted, tidied and the warehouse follows, twenty times over."""
    store, seen, faults, done = Store(root), [], [], threading.Event()
    put(spark, store, [order(1)], 0)
    catalog.create_warehouse(spark, "shop_polled", store)

    def poll():
        while not done.is_set():
            try:
                seen.append(spark.table("shop_polled.orders").count())
            except Exception as problem:
                faults.append(str(problem)[:300])

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for n in range(1, 21):
            put(spark, store, [order(n + 1, date=f"2026-06-{n % 4 + 1:02d}")], n)
            if n % 3 == 0:
                layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated, open_batches=1)
            catalog.refresh_warehouse(spark, "shop_polled", store)
    finally:
        done.set()
        reader.join()
    assert not faults and seen == sorted(seen) and len(set(seen)) > 3
    assert spark.table("shop_polled.orders").count() == 21


def test_a_refresh_changes_only_what_differs(spark, root):
    store = Store(root)
    for n in range(3):
        put(spark, store, [order(n, date=f"2026-06-0{n + 1}")], n)
    catalog.create_database(spark, "shop_diff", f"{root}/warehouse")
    refresh = lambda: catalog.refresh_topic(spark, "shop_diff", "orders", store)
    assert refresh() == (3, 0) and refresh() == (3, 0) and refresh() == (0, 0)  # each of the two tables once
    put(spark, store, [order(9, date="2026-06-09")], 3)
    assert refresh() == (1, 0) and refresh() == (1, 0)
    compact_all(spark, store)
    assert refresh() == (4, 4)  # four batches became a folder per date
    assert spark.table("shop_diff.orders").count() == 4
    tidy(spark, store)
    put(spark, store, [order(10, date="a/b c+%41=é")], 4)
    assert refresh() == (5, 4)
    assert spark.table("shop_diff.orders").where("dt = 'a/b c+%41=é'").count() == 1
    assert refresh() == (1, 0) and refresh() == (0, 0)
    shown = {r["tableName"] for r in catalog.list_tables(spark, "shop_diff").collect()}
    assert shown == {"orders", "orders_files_a", "orders_files_b"}


def test_a_database_made_anew(spark, root):
    store = Store(root)
    put(spark, store, [order(1)], 0)
    for anew in (False, True):
        catalog.create_warehouse(spark, "shop_anew", store, anew=anew)
        assert spark.table("shop_anew.orders").count() == 1
    assert "orders_files_b" not in {r["tableName"] for r in catalog.list_tables(spark, "shop_anew").collect()}


def test_warehouse_shows_all_rows_at_any_time(spark, root):
    store = Store(root)
    seen = lambda: spark.table("shop_live.orders").count()
    put(spark, store, [order(1), order(2, date="16/05/2026")], 0)
    put(spark, store, [order(3)], 1)
    put(spark, store, [payment(1)], 0, topic="payments")
    catalog.create_warehouse(spark, "shop_live", store)
    assert seen() == 3
    assert spark.table("shop_live.orders").where("dt = '16/05/2026'").count() == 1
    args = jobs.parse(["compact", "--root", root, "--database", "shop_live"])
    for n in range(2, 4):
        jobs.compact(spark, store, args)
        assert seen() == layers.read_curated(spark, store, "orders").count()
        put(spark, store, [order(2 * n), order(2 * n + 1)], n)
        jobs.tidy(spark, store, args)
        assert seen() == layers.read_curated(spark, store, "orders").count()
    args = jobs.parse(["nightly", "--root", root, "--as-of", "2026-07-01", "--database", "shop_live"])
    for n in range(3):
        put(spark, store, [order(100 + n)], 10 + n)
        jobs.run_nightly(spark, store, args)
        jobs.tidy(spark, store, args)
        total = spark.table("shop_live.daily_sales_summary").agg(F.sum("total_orders")).first()[0]
        assert total == layers.read_curated(spark, store, "orders").count()


def test_amounts_that_cannot_be_summed_are_rejected(spark):
    bodies = [order(1), *({**order(2 + n), "final_amount": v} for n, v in enumerate((2e17, 9e16, -1.0, None)))]
    rows = raw(spark, "orders", bodies)
    odd = rows.where("order_id = 'ORD1'")
    for value in ("NaN", "Infinity", "-Infinity"):
        rows = rows.unionByName(odd.withColumn("final_amount", F.lit(value).cast("double")))
    assert CLEAN["orders"](rows).count() == 1
    assert [r[0] for r in rows.select(first_failure("orders")).distinct().collect()].count("final_amount") == 1
    for value in ("NaN", "Infinity"):
        kept = CLEAN["orders"](odd.withColumn("discount", F.lit(value).cast("double"))).first()
        assert kept["discount"] == 0.0 and kept["is_discounted"] is False


def test_long_values_are_exported_whole(spark):
    items = [{"product_id": f"P{n}", "product_name": "x" * 100, "category": "c", "unit_price": 1.0, "quantity": 1, "item_total": 1.0} for n in range(300)]
    text = export_safe(curated(spark, "orders", [order(1, items=items)])).first()["items"]
    back = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", f"array<struct<{schemas.LINE_ITEM}>>")).first()[0]
    assert len(text) > 40_000 and len(back) == 300


def test_metrics_take_one_shuffle_and_the_latest_name(spark):
    at = "2026-05-16T10:00:00"
    rows = [
        order(1, customer_id="C", customer_name="Old", timestamp="2026-05-15T10:00:00"),
        order(2, customer_id="C", customer_name="Zed", customer_email="z@x", timestamp=at),
        order(3, customer_id="C", customer_name="Amy", customer_email="a@x", timestamp=at),  # same time, greater id
    ]
    df = curated(spark, "orders", rows)
    found = customer_metrics(df, "2026-06-01").collect()
    assert [(r["customer_name"], r["customer_email"], r["total_orders"]) for r in found] == [("Amy", "a@x", 3)]
    split = customer_metrics(df, "2026-06-01", by_identity=True).collect()
    assert sorted((r["customer_name"], r["total_orders"]) for r in split) == [("Amy", 1), ("Old", 1), ("Zed", 1)]
    text = customer_metrics(df, "2026-06-01")._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max_by" in text.split("Exchange hashpartitioning")[1]


@pytest.fixture
def broken(spark, tmp_path):
    """A table whose schema reads and whose rows do not."""
    folder = str(tmp_path / "broken")
    spark.range(2000).selectExpr("cast(id as string) AS order_id", "id AS n").coalesce(1).write.parquet(folder)
    file = glob.glob(f"{folder}/*.parquet")[0]
    size = os.path.getsize(file)
    with open(file, "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * (size // 2))
    for crc in glob.glob(f"{folder}/.*.crc"):
        os.remove(crc)
    return folder


def test_a_sheet_that_cannot_be_read_is_skipped(spark, broken, root):
    sheets = {"Bad": lambda t: spark.read.parquet(broken), "Good": lambda t: spark.range(3)}
    found = {r["sheet"]: (r["rows"], r["status"]) for r in report.write_report(spark, Tables(None), sheets, root).collect()}
    assert found["Good"] == (3, "written") and found["Bad"][1].startswith("skipped")


def test_a_step_that_cannot_read_fails_alone(spark, broken, root):
    orders = curated(spark, "orders", [order(n) for n in range(5)])

    def load(name):
        if name == "orders":
            return orders
        schema = curated(spark, "payments", [payment(1)]).schema
        return spark.read.parquet(broken).select(*(F.col("order_id").cast(f.dataType).alias(f.name) for f in schema))

    found = {r["summary"]: r["status"] for r in nightly.run_nightly(spark, Tables(load), Store(root), "2026-06-01").collect()}
    assert found.pop("payment_analysis").startswith("failed")
    assert set(found.values()) == {"written"}


def test_a_product_listed_twice_does_not_multiply_lines(spark):
    lines = spark.createDataFrame([("P1", "a", "c", 1.0), ("P2", "b", "c", 1.0)], "product_id string, product_name string, category string, unit_price double")
    same = lines.unionByName(lines.where("product_id = 'P1'"))
    differing = lines.unionByName(lines.where("product_id = 'P1'").withColumn("category", F.lit("d")))
    counts = lambda p: {r["status"]: r["lines"] for r in quality.catalogue_check_counts(lines, p).collect()}
    assert counts(same) == {"OK": 2}
    assert counts(differing) == {"OK": 1, "DUPLICATE_PRODUCT": 1}


def test_a_range_of_dates_reads_its_folders_only(spark, root):
    store = Store(root)
    put(spark, store, [order(n, date=f"2026-05-{10 + n}") for n in range(9)], 0)
    compact_all(spark, store)
    tables = Tables(lambda name: layers.read_curated(spark, store, name)).between("2026-05-12", "2026-05-13")
    found = analytics.revenue_by_region(tables)
    assert found.agg(F.sum("total_orders")).first()[0] == 2
    limit = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "10000")  # so that the plan's text has its filters whole
    try:
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    filters = text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert re.search(r"date#\d+ >= 2026", filters)


def test_a_breakdown_shows_all_values(spark):
    df = spark.range(30).selectExpr("id AS v")
    assert analytics.breakdown(df, "v").count() == 30 and analytics.breakdown(df, "v", top=10).count() == 10


def test_dates_of_one_row_are_dealt_out_as_well(spark):
    """A date with most rows is shared out, and dates of a row each do not end up in the task of a few rows."""
    days = [f"2026-{m:02d}-{d:02d}" for m in (1, 2) for d in range(1, 21)]
    bodies = [order(n, date="2026-05-16") for n in range(800)] + [order(1000 + n, date=d) for n, d in enumerate([*days, "soon"])]
    rows = curated(spark, "orders", bodies)
    dealt = layers.dealt_by_date(rows, 4, len(bodies)).withColumn("task", F.spark_partition_id())
    tasks = {r["task"]: r for r in dealt.groupBy("task").agg(F.count("*").alias("n"), F.countDistinct("date").alias("dates")).collect()}
    assert len(tasks) == 4 and max(r["n"] for r in tasks.values()) < 400 and max(r["dates"] for r in tasks.values()) < 25
    assert dealt.where("date <> '2026-05-16'").select("date", "task").distinct().count() == 41
    assert sorted(r[0] for r in dealt.select("order_id").collect()) == sorted(r[0] for r in rows.select("order_id").collect())


def test_rows_in_order_of_their_dates_are_not_moved(spark):
    """Tasks that share hardly a date write few files as they are; rows in any other order are dealt out."""
    bodies = [order(n, date=f"2026-05-{1 + n // 40:02d}") for n in range(800)]
    rows = curated(spark, "orders", bodies)
    in_order = rows.repartitionByRange(4, "kafka_offset").cache()
    mixed = rows.repartition(4, "order_id").cache()
    one_busy = rows.coalesce(1).cache()
    try:
        moved = lambda df: layers.dealt_by_date(df, 4, 800) is not df
        assert not moved(in_order) and moved(mixed) and moved(one_busy)
        assert layers.dealt_by_date(rows.limit(0), 4, 0).count() == 0
    finally:
        for df in (in_order, mixed, one_busy):
            df.unpersist()


def test_layers_are_stored_without_a_copy_on_the_way_and_small(spark, root):
    """Messages need no stored raw rows; layers and messages take a compact codec, compaction included."""
    shop = Workspace(spark, shop_tables(f"{root}/tables", orders=100))
    try:
        store = shop.compacted("payments")
        assert not os.path.exists(f"{shop.root}/raw_payments")
        for folder in (f"{shop.root}/envelopes", store.raw("payments"), store.curated("payments")):
            names = [n for _, _, found in os.walk(folder) for n in found if n.endswith(".parquet")]
            assert names and all(n.endswith(".zstd.parquet") for n in names)
        assert layers.read_curated(spark, store, "payments").count() == 100 == layers.read_raw(spark, store, "payments").count()
    finally:
        shop.release()


def test_temporary_views_are_no_tables_of_a_database(spark, root):
    catalog.create_database(spark, "shop_own", f"{root}/warehouse")
    spark.range(1).createOrReplaceTempView("passing_by")
    try:
        assert catalog.list_tables(spark, "shop_own").count() == 0
    finally:
        spark.catalog.dropTempView("passing_by")


def test_compaction_without_dates_moves_no_row(spark, root):
    spark.range(0, 1000, 1, 12).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    few = layers.in_few_files(rows, 2 * layers.ONE_TASK)
    few.write.parquet(f"{root}/few")
    assert "Exchange" not in few._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(f"{root}/few").count() == 1000 and 1 <= len(spark.read.parquet(f"{root}/few").inputFiles()) <= 2
