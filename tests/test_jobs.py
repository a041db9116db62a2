"""The jobs one after the other, as an operator runs them."""

import pytest

from mercato import jobs
from mercato.plans import analytics, incremental
from mercato.streaming import layers, stateful
from mercato.streaming.layers import Store
from tests.helpers import envelope, event, order, payment


def test_whole_day(spark, root, capsys):
    bodies = {
        "orders": [order(i, customer_id=f"C{i % 4}", final_amount=100.0 * (i + 1)) for i in range(12)] + ["bad"],
        "payments": [payment(i) for i in range(12)],
        "user_events": [event(i) for i in range(20)],
    }
    for topic, messages in bodies.items():
        envelope(spark, topic, messages).repartition(3).write.parquet(f"{root}/in/{topic}")
    store = f"{root}/shop"
    # one file per batch, so there are closed batches to compact
    jobs.main(["ingest", "--root", store, "--files", f"{root}/in", "--max-files", "1", "--once"])
    told = capsys.readouterr().out
    assert told.count("orders batch") == 3 and "1 dropped" in told

    jobs.main(["watch", "--root", store, "--files", f"{root}/in", "--once"])

    jobs.main(["compact", "--root", store])
    assert layers.date_folders(spark, Store(store).curated("orders"))
    assert layers.read_curated(spark, Store(store), "orders").count() == 12
    assert layers.read_raw(spark, Store(store), "orders").count() == 13
    jobs.main(["tidy", "--root", store])
    assert capsys.readouterr().out.count(": 2 batches dropped") == 6
    assert layers.read_raw(spark, Store(store), "orders").count() == 13
    assert layers.read_curated(spark, Store(store), "orders").count() == 12

    jobs.main(["nightly", "--root", store, "--as-of", "2026-07-01"])
    assert capsys.readouterr().out.count("written") == 4

    jobs.main(["verify", "--root", store])
    assert "churn_candidates" in capsys.readouterr().out

    views = jobs.stored_tables(spark, Store(store))
    by_device = spark.sql("SELECT device, count(order_id), sum(final_amount) FROM orders GROUP BY 1").collect()
    by_api = analytics.warehouse_device_share(views).collect()
    assert sorted(tuple(r) for r in by_device) == sorted(tuple(r[:3]) for r in by_api)
    segments = spark.sql("SELECT rfm_segment, COUNT(*) FROM customer_rfm GROUP BY rfm_segment").collect()
    assert sorted(tuple(r) for r in segments) == sorted(
        (r["rfm_segment"], r["customer_count"]) for r in analytics.warehouse_rfm_segments(views).collect()
    )

    jobs.main(["analyse", "--root", store, "--only", "revenue_by_region", "rfm_distribution"])
    assert "7800.0" in capsys.readouterr().out

    jobs.main(["report", "--root", store, "--out", f"{root}/report"])
    assert capsys.readouterr().out.count("written") == 10

    jobs.main(["export", "--root", store, "--out", f"{root}/export"])
    assert "Churn_Candidates_Raw" in capsys.readouterr().out
    back = spark.read.options(header="true", escape='"').csv(f"{root}/export/Orders_Raw")
    assert back.count() == 12 and '"product_id":"P007"' in back.first()["items"]

    jobs.main(["warehouse", "--root", store, "--database", "shop_jobs"])
    assert "daily_sales_summary" in capsys.readouterr().out
    assert spark.table("shop_jobs.churn_candidates").count() == 4


def test_a_day_with_state(spark, root, capsys):
    """Repeats dropped and payments reconciled while ingesting, a live warehouse, and incremental nights."""
    store, provider = f"{root}/shop", spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def land(first, n):
        for topic, make in (("orders", order), ("payments", payment), ("user_events", event)):
            bodies = [make(i) for i in range(first, first + n)] + [make(first)]
            envelope(spark, topic, bodies, first).coalesce(1).write.mode("append").parquet(f"{root}/in/{topic}")

    try:
        land(0, 5)
        ingest = ["ingest", "--root", store, "--files", f"{root}/in", "--once", "--unique", "2 hours", "--reconcile", "--database", "shop_state"]
        jobs.main(ingest)
        jobs.main(["warehouse", "--root", store, "--database", "shop_state"])
        assert spark.table("shop_state.orders").count() == 6
        jobs.main(["nightly", "--root", store, "--as-of", "2026-07-01", "--incremental", "--buckets", "2", "--database", "shop_state"])
        land(10, 3)
        jobs.main(ingest)
        assert spark.table("shop_state.orders").count() == 10  # without another job
        jobs.main(["nightly", "--root", store, "--as-of", "2026-07-02", "--incremental", "--database", "shop_state"])
        jobs.main(["recover", "--root", store])
        assert capsys.readouterr().out.count(": 0 recovered") == 3
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    opened = Store(store)
    for topic in layers.TOPICS:
        assert stateful.read_unique(spark, opened, topic).count() == 8
    assert stateful.read_reconciled(spark, opened).where("status = 'OK'").count() == 8
    assert incremental.customer_metrics(spark, opened, "2026-07-02").agg({"total_orders": "sum"}).first()[0] == 10
    assert spark.table("shop_state.customer_rfm").count() == 3
    assert spark.table("shop_state.daily_sales_summary").agg({"total_orders": "sum"}).first()[0] == 10
    assert spark.table("shop_state.payment_analysis").schema["analysis_date"].dataType.simpleString() == "string"


def test_analysis_without_its_table_is_skipped(spark, root, capsys):
    jobs.main(["analyse", "--root", f"{root}/none", "--only", "revenue_by_region"])
    assert "skipped" in capsys.readouterr().out


def test_missing_option_is_named(capsys):
    with pytest.raises(SystemExit):
        jobs.parse(["nightly", "--root", "r"])
    assert "--as-of" in capsys.readouterr().err
