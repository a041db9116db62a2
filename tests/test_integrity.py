"""Order checks on storage by order id: the same rows as from the tables, and nothing moves."""

import glob
import re

import pytest

from mercato.operators import quality
from mercato.plans import integrity
from mercato.queries import build_queries
from mercato.sources import buckets
from mercato.streaming.layers import Store
from tests.helpers import curated, order, payment

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def lines(spark, n, order_id="ORD1", price=10.0, total=20.0):
    return spark.createDataFrame([(order_id, price, 2, total)] * n, "order_id string, unit_price double, quantity int, item_total double")


@pytest.mark.parametrize("name", ["quality_line_checks_stored", "quality_payment_reconciliation_stored"])
def test_stored_checks_move_nothing(spark, name):
    text = build_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("Bucketed: true") == 2
    assert "Outer" in text


def test_checks_grow_with_runs_and_a_repeated_run_replaces_itself(spark, root):
    stored = integrity.ByOrder(spark, Store(root), 3)
    orders = curated(spark, "orders", [order(i, num_items=4, subtotal=80.0) for i in range(6)])
    first, second = orders.where("order_id < 'ORD3'"), orders.where("order_id >= 'ORD3'")
    payments = curated(spark, "payments", [payment(i) for i in range(1, 8)])
    stored.add_orders(first, 1)
    stored.add_lines(lines(spark, 3), 1)
    stored.add_sides(first, payments.where("payment_id < 'PAY4'"), 1)
    for _ in range(2):  # the second attempt is the one that counts
        stored.add_orders(second, 2)
        stored.add_lines(lines(spark, 1).unionByName(lines(spark, 4, "ORD4", total=21.0)), 2)
        stored.add_sides(second, payments.where("payment_id >= 'PAY4'"), 2)
    every = lines(spark, 4).unionByName(lines(spark, 4, "ORD4", total=21.0))
    assert rows(stored.line_checks()) == rows(quality.line_checks(orders, every))
    assert rows(stored.reconciliation()) == rows(quality.reconcile_payments(orders, payments))
    for run in (1, 2):
        files = glob.glob(f"{root}/by_order/orders/run={run}/*.parquet")
        assert 0 < len(files) <= 3 and all(re.search(r"_0000\d\.c000", f) for f in files)  # the bucket is in the name


def test_an_order_with_most_lines_is_a_row_per_run(spark, root):
    stored = integrity.ByOrder(spark, Store(root), 2)
    stored.add_lines(lines(spark, 5000), 1)
    stored.add_lines(lines(spark, 5000), 2)
    stored.add_orders(curated(spark, "orders", [order(1, num_items=10_000, subtotal=200_000.0)]), 1)
    assert spark.table(buckets.table_name(f"{root}/by_order/lines")).count() == 2
    assert stored.line_checks().first()["status"] == "OK"


def test_another_application_finds_the_buckets(spark, root):
    stored = integrity.ByOrder(spark, Store(root), 4)
    stored.add_lines(lines(spark, 3), 1)
    spark.sql(f"DROP TABLE {buckets.table_name(f'{root}/by_order/lines')}")
    again = integrity.ByOrder(spark, Store(root), 4)._table("lines")
    assert again.count() == 1
    assert "Exchange" not in again.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
