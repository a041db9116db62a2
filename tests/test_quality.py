from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.plans import analytics
from mercato.plans.tables import Tables
from tests.helpers import curated, event, order, payment


def counts(df):
    return {r[0]: r[1] for r in df.collect()}


def line(price, quantity, total, product="P007"):
    return {"product_id": product, "product_name": "Yoga Mat Premium", "category": "Sports",
            "unit_price": price, "quantity": quantity, "item_total": total}


def test_lines_against_headers(spark):
    df = curated(
        spark, "orders",
        [
            order(1, items=[line(10, 2, 20)], subtotal=20, num_items=1),
            order(2, items=[line(10, 2, 21)], subtotal=21, num_items=1),
            order(3, items=[line(10, 2, 20)], subtotal=25, num_items=1),
            order(4, items=[line(10, 2, 20)], subtotal=20, num_items=2),
            order(5, items=[], subtotal=20, num_items=1),
        ],
    )
    found = {r["order_id"]: r["status"] for r in quality.line_checks(df, quality.explode_items(df)).collect()}
    assert found == {
        "ORD1": "OK", "ORD2": "LINE_TOTAL_MISMATCH", "ORD3": "SUBTOTAL_MISMATCH",
        "ORD4": "COUNT_MISMATCH", "ORD5": "NO_LINES",
    }


def test_amounts(spark):
    df = curated(
        spark, "orders",
        [order(1, subtotal=100.1, discount=0.1, final_amount=100.0),
         order(2, subtotal=100.1, discount=0.0, final_amount=100.0),
         order(3, subtotal=None)],
    )
    assert counts(quality.amount_check_counts(df)) == {"OK": 1, "AMOUNT_MISMATCH": 1, "NO_SUBTOTAL": 1}


def test_payments_against_orders(spark):
    orders = curated(spark, "orders", [order(i) for i in (1, 2, 3, 4, 6)] + [order(6)])
    payments = curated(
        spark, "payments",
        [payment(1), payment(2, amount=99.0), payment(3, customer_id="other"), payment(5), payment(6)],
    )
    found = {r["order_id"]: r["status"] for r in quality.reconcile_payments(orders, payments).collect()}
    assert found == {
        "ORD1": "OK", "ORD2": "AMOUNT_MISMATCH", "ORD3": "CUSTOMER_MISMATCH",
        "ORD4": "ORDER_WITHOUT_PAYMENT", "ORD5": "PAYMENT_WITHOUT_ORDER", "ORD6": "REPEATED",
    }


def test_search_events(spark):
    df = curated(
        spark, "user_events",
        [event(1), event(2, event_type="SEARCH"), event(3, event_type="SEARCH", product_id=None),
         event(4, event_type="SEARCH", product_id=None, search_query="q"),
         event(5, search_query="q"), event(6, product_id=None)],
    )
    assert counts(quality.search_check_counts(df)) == {
        "OK": 2, "SEARCH_WITH_PRODUCT": 1, "SEARCH_WITHOUT_QUERY": 1, "QUERY_OUTSIDE_SEARCH": 1,
        "PRODUCT_MISSING": 1,
    }


def test_places(spark):
    df = curated(spark, "orders", [order(1), order(2, city=" Pune "), order(3, region="West", city="Pune")])
    assert [tuple(r) for r in quality.unknown_places(df).collect()] == [("SOUTH", "Pune", 1)]


def test_domains(spark):
    df = curated(spark, "orders", [order(1), order(2, device="Watch"), order(3, status=None)])
    found = {(r["field"], r["value"]): (r["known"], r["rows"]) for r in quality.domain_counts(df, "orders").collect()}
    assert found == {
        ("orders.status", "PLACED"): (True, 2), ("orders.status", None): (False, 1),
        ("orders.device", "MOBILE"): (True, 2), ("orders.device", "WATCH"): (False, 1),
    }


def test_repeated_ids(spark):
    df = curated(spark, "payments", [payment(1), payment(1), payment(2)])
    assert [tuple(r) for r in quality.duplicate_ids(df, "payment_id").collect()] == [("PAY1", 2)]
    assert quality.deduplicate(df, "payment_id").count() == 2


def test_the_earliest_copy_stays(spark):
    df = spark.createDataFrame(
        [("P", 2, "late"), ("P", 1, "first"), ("P", None, "undated"), ("Q", 3, "only")],
        "id string, kafka_timestamp int, note string",
    ).filter("kafka_timestamp is not null")
    kept = quality.deduplicate(df, "id").orderBy("id").collect()
    assert [tuple(r) for r in kept] == [("P", 1, "first"), ("Q", 3, "only")]


def test_catalogue(spark):
    df = curated(
        spark, "orders",
        [order(1), order(2, items=[line(5, 1, 5)]), order(3, items=[line(1299, 1, 1299, "P999")])],
    )
    assert counts(quality.catalogue_check_counts(quality.explode_items(df))) == {
        "OK": 1, "PRICE_MISMATCH": 1, "UNKNOWN_PRODUCT": 1
    }


def test_ties_in_samples_go_by_id(spark):
    df = curated(spark, "orders", [order(i) for i in (3, 1, 2)])
    t = Tables(lambda name: df)
    assert [r["order_id"] for r in analytics.sheet_orders_sample(t).collect()] == ["ORD1", "ORD2", "ORD3"]


def test_shares_add_up(spark):
    df = curated(spark, "orders", [order(i, device=d) for i, d in enumerate("aabbbcd")])
    total = analytics.warehouse_device_share(Tables(lambda name: df)).agg(F.sum("percentage")).first()[0]
    assert abs(total - 100) < 0.05


def test_latest_rows_read_only_the_dates_they_need(spark, root):
    dates = ["2026-05-01"] * 3 + ["2026-05-02"] * 2 + ["2026-05-03"] + [None]
    spark.createDataFrame(list(enumerate(dates)), "id int, date string").write.partitionBy("date").parquet(f"{root}/t")
    df = spark.read.schema("id int, date string").parquet(f"{root}/t")

    def ids(n):
        return [r["id"] for r in analytics.latest_rows(df, n, "id").collect()]

    assert [ids(n) for n in (1, 2, 3, 4, 6)] == [[5], [5, 3], [5, 3, 4], [5, 3, 4, 0], [5, 3, 4, 0, 1, 2]]
    assert ids(9) == [5, 3, 4, 0, 1, 2, 6]  # fewer rows than asked for: undated ones come last
    plan = analytics.latest_rows(df, 2, "id")._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan and ">= 2026-05-02" in plan.split("PartitionFilters")[1]
