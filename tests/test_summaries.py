import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mercato.operators.customers import customer_metrics
from mercato.plans import nightly, summaries
from mercato.plans.tables import Tables
from mercato.sources.snapshots import read_snapshot
from mercato.streaming.layers import Store
from tests.helpers import curated, order, payment


def orders(spark, *changes):
    return curated(spark, "orders", [order(i, **c) for i, c in enumerate(changes)])


def test_daily_sales(spark):
    df = orders(
        spark,
        dict(final_amount=60000.0, discount=5.0, device="Mobile"),
        dict(final_amount=0.01, status="CANCELLED", device="Desktop"),
        dict(final_amount=0.02, region="north ", device="Tablet"),
    )
    rows = {r["region"]: r.asDict() for r in summaries.daily_sales(df, "2026-05-17").collect()}
    assert rows["SOUTH"] == {
        "date": "2026-05-16", "region": "SOUTH", "total_orders": 2, "total_revenue": 60000.01,
        "avg_order_value": 30000.01, "total_discount": 5.0, "high_value_orders": 1,
        "cancelled_orders": 1, "mobile_orders": 1, "desktop_orders": 1, "computed_at": "2026-05-17",
    }
    compat = summaries.daily_sales(df, "2026-05-17", compat=True)
    assert [r["mobile_orders"] + r["desktop_orders"] for r in compat.collect()] == [0, 0]


def test_daily_sales_of_given_dates(spark):
    df = orders(spark, dict(date="2026-05-16"), dict(date="2026-05-17"), dict(date="2026-05-18"))
    some = summaries.daily_sales(df, "2026-05-19", dates=["2026-05-16", "2026-05-18"])
    assert sorted(r["date"] for r in some.collect()) == ["2026-05-16", "2026-05-18"]


def test_total_of_daily_sales_is_the_number_of_orders(spark):
    df = orders(spark, *[dict(date=f"2026-05-{10 + i % 7}", region=f"r{i % 3}") for i in range(40)])
    assert summaries.daily_sales(df, "2026-06-01").agg(F.sum("total_orders")).first()[0] == df.count()


def test_one_row_per_customer_with_the_latest_name(spark):
    df = orders(
        spark,
        dict(customer_id="C", customer_name="Old", timestamp="2026-05-01T08:00:00", date="2026-05-01"),
        dict(customer_id="C", customer_name="New", timestamp="2026-05-09T08:00:00", date="2026-05-09"),
        dict(customer_id="C", customer_name="Mid", timestamp="2026-05-05T08:00:00", date="2026-05-05"),
    )
    row = customer_metrics(df, "2026-05-10").first().asDict()
    assert row == {
        "customer_id": "C", "customer_name": "New", "customer_email": "a@example.com",
        "last_order_date": "2026-05-09", "days_since_order": 1, "total_orders": 3,
        "total_revenue": 300.0, "avg_order_value": 100.0,
    }
    assert customer_metrics(df, "2026-05-10", by_identity=True).count() == 3


def test_churn_band_edges(spark):
    days = [29, 30, 59, 60, 89, 90]
    df = spark.createDataFrame(
        [(str(d), "n", "e", "2026-01-01", d, 1, 1.0, 1.0) for d in days],
        "customer_id string, customer_name string, customer_email string, last_order_date string, "
        "days_since_order int, total_orders bigint, total_revenue double, avg_order_value double",
    )
    found = {r["days_since_order"]: r["churn_risk"] for r in summaries.churn_from_metrics(df, "2026-05-01").collect()}
    assert found == {30: "LOW", 59: "LOW", 60: "MEDIUM", 89: "MEDIUM", 90: "HIGH"}


@pytest.mark.parametrize(
    "total, segment",
    [(3, "LOST_CUSTOMERS"), (4, "LOST_CUSTOMERS"), (5, "AT_RISK"), (6, "AT_RISK"),
     (7, "POTENTIAL_LOYALISTS"), (9, "POTENTIAL_LOYALISTS"), (10, "LOYAL_CUSTOMERS"),
     (12, "LOYAL_CUSTOMERS"), (13, "CHAMPIONS"), (15, "CHAMPIONS")],
)
def test_rfm_segment_edges(spark, total, segment):
    from mercato import schemas
    from mercato.functions.text import band

    assert spark.range(1).select(band(F.lit(total), schemas.RFM_BANDS, "LOST_CUSTOMERS")).first()[0] == segment


def _customers(spark):
    return orders(
        spark,
        *[
            dict(customer_id=f"C{i}", date=f"2026-05-{i + 1:02d}", timestamp=f"2026-05-{i + 1:02d}T00:00:00",
                 final_amount=100.0 * (i + 1))
            for i in range(10)
        ],
    )


def test_recent_customers_score_high_and_compat_the_other_way(spark):
    df = _customers(spark)
    for compat, latest, oldest in ((False, 5, 1), (True, 1, 5)):
        scores = {
            r["customer_id"]: r["recency_score"]
            for r in summaries.rfm_scores(df, "2026-06-01", compat).collect()
        }
        # the literal rule gives the oldest customers the first tile, and 6 - 1
        assert (scores["C9"], scores["C0"]) == (latest, oldest)


def test_payment_analysis(spark):
    df = curated(
        spark, "payments",
        [payment(1), payment(2, status="FAILED"), payment(3), payment(4, payment_method="Wallet")],
    )
    rows = {r["payment_method"]: r for r in summaries.payment_analysis(df, "2026-05-17").collect()}
    upi = rows["UPI"]
    assert (upi["total_transactions"], upi["successful"], upi["failed"], upi["success_rate"]) == (3, 2, 1, 66.67)


def _tables(spark, payments=True):
    def load(name):
        if name == "orders":
            return _customers(spark)
        if name == "payments" and payments:
            return curated(spark, "payments", [payment(1)])
        raise FileNotFoundError(name)

    return Tables(load)


def test_nightly_writes_four_snapshots(spark, root):
    store = Store(root)
    manifest = nightly.run_nightly(spark, _tables(spark), store, "2026-06-01")
    assert [(r["summary"], r["status"], r["rows"]) for r in manifest.collect()] == [
        ("daily_sales", "written", 10), ("customer_rfm", "written", 10),
        ("churn_candidates", "written", 2), ("payment_analysis", "written", 1),
    ]
    assert read_snapshot(spark, store.summary("customer_rfm")).count() == 10


def test_nightly_skips_what_has_no_input(spark, root):
    manifest = nightly.run_nightly(spark, _tables(spark, payments=False), Store(root), "2026-06-01")
    assert [r["status"] for r in manifest.collect()] == ["written", "written", "written", "skipped"]


def test_nightly_waits_for_daily_sales(spark, root, monkeypatch):
    def broken(*_):
        raise PySparkException("no")

    monkeypatch.setattr(summaries, "daily_sales", broken)
    manifest = nightly.run_nightly(spark, _tables(spark), Store(root), "2026-06-01")
    assert [r["status"].split(":")[0] for r in manifest.collect()] == ["failed", "blocked", "blocked", "blocked"]


def test_nightly_rerun_of_one_day_keeps_the_others(spark, root):
    store = Store(root)
    nightly.run_nightly(spark, _tables(spark), store, "2026-06-01")
    nightly.run_nightly(spark, _tables(spark), store, "2026-06-02", dates=["2026-05-03"])
    stamps = {r["date"]: r["computed_at"] for r in read_snapshot(spark, store.summary("daily_sales")).collect()}
    assert len(stamps) == 10
    assert {d for d, s in stamps.items() if s == "2026-06-02"} == {"2026-05-03"}
