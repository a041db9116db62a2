import math
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from mercato import schemas
from mercato.operators.export import export_safe, file_inventory
from mercato.plans import analytics, catalog, nightly, report
from mercato.plans.tables import Tables
from mercato.session import shared_folder, stage, staged
from mercato.sources import snapshots
from mercato.sources.tables import TableEntry, has_rows, register_tables, scan
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store
from tests.helpers import curated, event, order, payment, raw


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_staged_table_goes_and_stage_stays(spark):
    with staged(spark.range(3), "t") as df:
        assert df.count() == 3
        folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert not os.path.exists(folder)
    assert stage(spark.range(3), "t").count() == 3


# -- snapshots ----------------------------------------------------------------
def test_snapshot_is_replaced_and_may_read_itself(spark, root):
    assert not snapshots.snapshot_exists(spark, root)
    assert snapshots.write_snapshot(spark.range(3), root) == 3
    old = snapshots.read_snapshot(spark, root)
    assert snapshots.write_snapshot(old.filter("id > 0"), root) == 2
    assert old.count() == 3  # a reader of the old version is not disturbed
    assert snapshots.read_snapshot(spark, root).count() == 2


def test_empty_result_is_a_snapshot_too(spark, root):
    empty = spark.range(9).groupBy((F.col("id") % 2).alias("k")).count().filter("count > 9")
    assert snapshots.write_snapshot(empty, root) == 0
    assert snapshots.read_snapshot(spark, root).columns == ["k", "count"]


def test_failed_write_leaves_the_last_version(spark, root):
    snapshots.write_snapshot(spark.range(3), root)
    with pytest.raises(Exception):
        snapshots.write_snapshot(spark.range(3).select(F.raise_error(F.lit("no")).alias("id")), root)
    assert snapshots.read_snapshot(spark, root).count() == 3


def test_snapshot_gains_a_column(spark, root):
    snapshots.write_snapshot(spark.range(2).select(F.col("id").cast("string").alias("date")), root)
    wider = spark.createDataFrame([("1", 5)], "date string, n int")
    snapshots.refresh_snapshot(wider, root, "date", ["1"])
    rows = {r["date"]: r["n"] for r in snapshots.read_snapshot(spark, root).collect()}
    assert rows == {"0": None, "1": 5}


def test_prune_keeps_the_latest(spark, root):
    for n in (1, 2, 3):
        snapshots.write_snapshot(spark.range(n), root)
    assert snapshots.prune_snapshots(spark, root, keep=1) == 2
    assert snapshots.read_snapshot(spark, root).count() == 3
    assert len([d for d in os.listdir(root) if d.startswith("version-")]) == 1


# -- tables -------------------------------------------------------------------
def test_register_skips_what_is_missing(spark, root):
    spark.range(4).write.parquet(f"{root}/good")
    entries = [
        TableEntry("good_view", "curated", lambda: scan(spark, f"{root}/good")),
        TableEntry("bad_view", "summaries", lambda: scan(spark, f"{root}/nowhere")),
    ]
    found = [tuple(r) for r in register_tables(spark, entries).collect()]
    assert found == [("good_view", "curated", True, 4), ("bad_view", "summaries", False, 0)]
    assert spark.table("good_view").count() == 4


def test_emptiness(spark):
    assert has_rows(spark.range(1)) and not has_rows(spark.range(0))


def test_scan_merges_columns_and_keeps_date_as_text(spark, root):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/t/date=2026-05-16")
    spark.createDataFrame([(2, 3)], "a int, b int").write.parquet(f"{root}/t/date=2026-05-17")
    df = scan(spark, f"{root}/t", evolve=True)
    assert dict(df.dtypes) == {"a": "int", "b": "int", "date": "string"}


# -- export -------------------------------------------------------------------
def test_export_forms(spark):
    rows = [
        (datetime(2026, 5, 27, 8, 39, 40), date(2026, 5, 27), [("a", 1)], {"k": 1}, math.nan, "nan"),
        (None, None, None, None, 1.5, "a\x00b\x0bc\td"),
        (None, None, None, None, None, "x" * 40000),
    ]
    df = spark.createDataFrame(
        rows, "t timestamp, d date, l array<struct<n:string,q:int>>, m map<string,int>, f double, s string"
    )
    out = [tuple(r) for r in export_safe(df, cell_limit=schemas.CELL_LIMIT).collect()]
    assert out[0] == ("2026-05-27 08:39:40", "2026-05-27", '[{"n":"a","q":1}]', '{"k":1}', None, None)
    assert out[1] == (None, None, None, None, 1.5, "abc\td")
    assert len(out[2][5]) == 32767
    assert len(export_safe(df, cell_limit=None).collect()[2]["s"]) == 40000


def _tables(spark):
    frames = {
        "orders": curated(spark, "orders", [order(i) for i in range(5)]),
        "payments": curated(spark, "payments", [payment(i) for i in range(4)]),
    }

    def load(name):
        if name not in frames:
            raise FileNotFoundError(name)
        return frames[name]

    return Tables(load)


def test_report_goes_on_after_a_failing_sheet(spark, root):
    sheets = {
        "Orders": analytics.sheet_orders_sample,
        "Customer RFM": analytics.sheet_customer_rfm,
        "Payments Sample": analytics.sheet_payments_sample,
    }
    done = report.write_report(spark, _tables(spark), sheets, root, limits={"Payments Sample": 2})
    assert [tuple(r) for r in done.collect()] == [
        ("Orders", 5, "written"), ("Customer RFM", 0, "skipped: FileNotFoundError"),
        ("Payments Sample", 2, "written"),
    ]
    back = spark.read.option("header", "true").csv(f"{root}/Orders")
    assert back.columns[:3] == ["order_id", "customer_name", "customer_email"] and back.count() == 5


def test_export_index(spark, root):
    tables = _tables(spark)
    entries = [
        TableEntry("orders", "curated", lambda: tables.orders, "Orders_Raw", "all orders"),
        TableEntry("churn_candidates", "summaries", lambda: tables.churn_candidates, "Churn_Raw", "risk"),
    ]
    index = report.export_tables(spark, entries, root)
    rows = [tuple(r)[:7] for r in index.collect()]
    assert rows == [
        ("Orders_Raw", "curated", "orders", "all orders", True, 5, 28),
        ("Churn_Raw", "summaries", "churn_candidates", "risk", False, None, None),
    ]
    assert index.first()["exported_at"].endswith(" UTC")
    assert tuple(report.exported_rows(index).first()) == (1, 5)


def test_file_inventory(spark, root):
    spark.range(10).repartition(3).write.parquet(f"{root}/a")
    spark.range(1).coalesce(1).write.parquet(f"{root}/b/date=x")
    found = {r["folder"].rsplit("/", 1)[1]: r["files"] for r in file_inventory(spark, root).collect()}
    assert found == {"a": 3, "date=x": 1}


# -- catalog ------------------------------------------------------------------
def test_warehouse(spark, root):
    store = Store(root)
    bodies = [order(1, date="2026-05-16"), order(2, date="2026-05-17"), order(3, date="2026-05-17")]
    layers.write_batch(raw(spark, "orders", bodies[:2]), 0, TOPICS["orders"], store, "r")
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    layers.write_batch(raw(spark, "orders", bodies[2:]), 1, TOPICS["orders"], store, "r")
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    layers.write_batch(raw(spark, "user_events", [event(1)]), 0, TOPICS["user_events"], store, "r")
    tables = Tables(lambda name: layers.read_curated(spark, store, name))
    nightly.run_nightly(spark, tables, store, "2026-06-01")

    for _ in range(2):  # dropping and recreating is part of it
        catalog.create_warehouse(spark, "shop_test", store, ("orders",))
    listed = sorted(r["dt"] for r in catalog.list_partitions(spark, "shop_test", "orders").collect())
    assert listed == ["2026-05-16", "2026-05-17"]
    names = [r["col_name"] for r in catalog.describe_table(spark, "shop_test", "orders").collect()]
    assert "order_timestamp" in names and "dt" in names and "timestamp" not in names
    counts = {r["dt"]: r["n"] for r in spark.sql(
        "SELECT dt, COUNT(*) AS n FROM shop_test.orders GROUP BY dt").collect()}
    assert counts == {"2026-05-16": 1, "2026-05-17": 2}
    first = spark.sql("SELECT order_timestamp FROM shop_test.orders LIMIT 1").first()[0]
    assert first == "2026-05-16T10:11:12.123456"

    plan = spark.sql("SELECT * FROM shop_test.orders WHERE dt = '2026-05-17'")
    assert "PartitionFilters: [isnotnull(dt" in plan._jdf.queryExecution().executedPlan().toString()

    t = Tables(lambda name: catalog.warehouse_table(spark, "shop_test", name))
    assert [r["total_orders"] for r in analytics.warehouse_daily_revenue(t).collect()] == [1, 2]
    assert spark.table("shop_test.daily_sales_summary").columns[0] == "sale_date"
    assert analytics.warehouse_rfm_segments(t).agg(F.sum("customer_count")).first()[0] == 3
    shown = {r["tableName"] for r in catalog.list_tables(spark, "shop_test").collect()}
    assert {"orders", "customer_rfm", "daily_sales_summary"} <= shown
    assert "shop_test" in {r[0] for r in catalog.list_databases(spark).collect()}


def test_undated_rows_reach_the_warehouse(spark, root):
    store = Store(root)
    batch = raw(spark, "orders", [order(1, date=None), order(2)])
    layers.write_batch(batch, 0, TOPICS["orders"], store, "r")
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    catalog.create_warehouse(spark, "shop_undated", store, ("orders",))
    rows = spark.sql("SELECT order_id, dt FROM shop_undated.orders ORDER BY order_id").collect()
    assert [tuple(r) for r in rows] == [("ORD1", None), ("ORD2", "2026-05-16")]
