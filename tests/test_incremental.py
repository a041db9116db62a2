"""Nightly runs that read only what is new, against the summaries of the whole layer."""

import os
import re

import pytest
from pyspark.sql import functions as F

from mercato.operators import customers
from mercato.plans import incremental, summaries
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store
from tests.helpers import event, order, payment, raw


def put(spark, store, topic, bodies, batch_id, run="r"):
    layers.write_batch(raw(spark, topic, bodies), batch_id, TOPICS[topic], store, run)


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def status(manifest):
    return {r["summary"]: (r["status"], r["rows"]) for r in manifest.collect()}


def orders_of(day, first, n, **changes):
    return [
        order(first + i, customer_id=f"C{(first + i) % 5}", customer_name=f"N{first + i}", final_amount=100.0 + first + i,
              date=day, timestamp=f"{day}T10:{i:02d}:00", **changes)
        for i in range(n)
    ]


DAYS = ["2026-05-16", "2026-05-17", "2026-05-18"]


def test_three_runs_equal_one_over_all(spark, root):
    store, whole = Store(f"{root}/three"), Store(f"{root}/one")
    for n, day in enumerate(DAYS):
        bodies = {
            "orders": orders_of(day, 10 * n, 7) + orders_of(DAYS[0], 10 * n + 8, 1),  # one of the first day each time
            "payments": [payment(10 * n + i, date=day) for i in range(4)],
            "user_events": [event(10 * n + i, customer_id=f"C{i + n}", date=day, device="mobile") for i in range(6)],
        }
        for topic, messages in bodies.items():
            put(spark, store, topic, messages, n)
            put(spark, whole, topic, messages, n)
        incremental.run(spark, store, f"2026-06-0{n + 1}", buckets=3)
    incremental.run(spark, whole, "2026-06-03", buckets=5)
    as_of = "2026-06-03"
    layer = layers.read_curated(spark, store, "orders")
    expected = customers.customer_metrics(layer, as_of)
    assert rows(incremental.customer_metrics(spark, store, as_of)) == rows(expected)
    assert rows(incremental.customer_metrics(spark, whole, as_of)) == rows(expected)
    sales = incremental.read_days(spark, store, "daily_sales")
    assert rows(sales.drop("computed_at")) == rows(summaries.daily_sales(layer, as_of).drop("computed_at"))
    stamps = {r["date"]: r["computed_at"] for r in sales.collect()}
    assert stamps == {DAYS[0]: "2026-06-03", DAYS[1]: "2026-06-02", DAYS[2]: "2026-06-03"}
    paid = incremental.read_days(spark, store, "payment_analysis")
    assert rows(paid.drop("computed_date")) == rows(summaries.payment_analysis(layers.read_curated(spark, store, "payments"), as_of).drop("computed_date"))


def test_a_fold_reads_new_batches_and_moves_nothing_of_the_state(spark, root):
    store = Store(root)
    put(spark, store, "orders", orders_of(DAYS[0], 0, 9), 0)
    incremental.run(spark, store, "2026-06-01", buckets=4)
    put(spark, store, "orders", orders_of(DAYS[1], 20, 9), 1)
    now = incremental.progress(spark, store)
    change = layers.changes(spark, store, "orders", now.seen["orders"])
    assert change.dates == [DAYS[1]] and change.rows.count() == 9
    assert {re.search(r"batch_id=(\d+)", f)[1] for f in change.rows.inputFiles()} == {"1"}
    state = incremental.stored_totals(spark, now.customers, now.buckets)
    after = incremental.folded(spark, change.rows, state, now.buckets)
    text = after._jdf.queryExecution().executedPlan().toString()
    stored = next(part for part in text.split("FileScan parquet")[1:] if "customer_totals_" in part.split("\n")[0] or "Bucketed: true" in part)
    assert "Bucketed: true" in stored
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = max(i for i in range(at) if "FullOuter" in lines[i])
    # between the join and the stored side there is no exchange on its branch
    depth = lambda line: len(re.match(r"[ :+\-*()0-9]*", line)[0])
    branch, level = [], depth(lines[at])
    for i in range(at, join, -1):
        if depth(lines[i]) <= level:
            branch.append(lines[i])
            level = depth(lines[i])
    assert not any("Exchange" in line for line in branch)
    assert "Python" not in text
    # the next version has a file per bucket at most
    incremental.run(spark, store, "2026-06-02")
    folder = incremental.progress(spark, store).customers
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 4


def files_of(folder):
    return {d: sorted(os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if d.startswith("date=")}


def test_a_late_order_rewrites_its_own_day_only(spark, root):
    store = Store(root)
    for n, day in enumerate(DAYS):
        put(spark, store, "orders", orders_of(day, 10 * n, 3), n)
    incremental.run(spark, store, "2026-06-01", buckets=2)
    folder = incremental.daily_folder(store, "daily_sales")
    before = files_of(folder)
    assert len(before) == 3
    put(spark, store, "orders", orders_of(DAYS[1], 50, 1), 3)
    assert status(incremental.run(spark, store, "2026-06-02"))["orders"] == ("written", 1)
    after = files_of(folder)
    assert {d for d in after if after[d] != before.get(d)} == {f"date={DAYS[1]}"}
    # a run without anything new leaves all days alone, and customers grow a day older
    found = status(incremental.run(spark, store, "2026-06-09"))
    assert found["orders"] == ("unchanged", 0) and found["customer_rfm"] == ("written", 3)
    assert files_of(folder) == after
    assert {r["days_since_order"] for r in incremental.customer_metrics(spark, store, "2026-06-09").collect()} <= {22, 23, 24}


def test_records_without_a_date(spark, root):
    store = Store(root)
    put(spark, store, "orders", orders_of(DAYS[0], 0, 2) + [order(90, date=None)], 0)
    incremental.run(spark, store, "2026-06-01", buckets=2)
    put(spark, store, "orders", [order(91, date=None), order(92, date="soon")], 1)
    assert status(incremental.run(spark, store, "2026-06-02"))["orders"] == ("written", 1)
    sales = {r["date"]: r["total_orders"] for r in incremental.read_days(spark, store, "daily_sales").collect()}
    assert sales == {DAYS[0]: 2, None: 2, "soon": 1}
    assert len(files_of(incremental.daily_folder(store, "daily_sales"))) == 2


def test_a_run_that_fails_is_repeated_whole(spark, root, monkeypatch):
    store = Store(root)
    for n in (0, 1):
        put(spark, store, "orders", orders_of(DAYS[n], 10 * n, 4), n)
        put(spark, store, "user_events", [event(10 * n + i, customer_id=f"C{10 * n + i}") for i in range(4)], n)
        if n == 0:
            incremental.run(spark, store, "2026-06-01", buckets=2)
    with monkeypatch.context() as m:
        m.setattr(incremental, "write_snapshot", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run(spark, store, "2026-06-02")
    assert rows(incremental.customer_metrics(spark, store, "2026-06-02").select("total_orders")) == [(1,)] * 4
    incremental.run(spark, store, "2026-06-02")
    layer = layers.read_curated(spark, store, "orders")
    assert rows(incremental.customer_metrics(spark, store, "2026-06-02")) == rows(customers.customer_metrics(layer, "2026-06-02"))
    numbers = sorted(r["number"] for r in incremental.customer_numbers(spark, store).collect())
    assert numbers == list(range(1, 9))


def test_tidied_batches_are_missed_and_rebuilt(spark, root):
    store = Store(root)
    for n, day in enumerate(DAYS):
        put(spark, store, "orders", orders_of(day, 10 * n, 3), n)
        if n == 0:
            incremental.run(spark, store, "2026-06-01", buckets=2)
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    layers.drop_covered_batches(spark, store.curated("orders"))
    put(spark, store, "orders", orders_of(DAYS[2], 50, 1), 3)
    with pytest.raises(FileNotFoundError, match="2 batches of orders"):
        incremental.run(spark, store, "2026-06-02")
    incremental.run(spark, store, "2026-06-02", buckets=3, rebuild=True)
    layer = layers.read_curated(spark, store, "orders")
    assert rows(incremental.customer_metrics(spark, store, "2026-06-02")) == rows(customers.customer_metrics(layer, "2026-06-02"))
    assert status(incremental.run(spark, store, "2026-06-03"))["orders"] == ("unchanged", 0)


def test_the_catalog_entry_of_the_totals_is_made_anew(spark, root):
    store = Store(root)
    put(spark, store, "orders", orders_of(DAYS[0], 0, 6), 0)
    incremental.run(spark, store, "2026-06-01", buckets=3)
    now = incremental.progress(spark, store)
    spark.sql(f"DROP TABLE {incremental._table_of(now.customers)}")  # as another application finds it
    assert incremental.customer_metrics(spark, store, "2026-06-01").count() == 5
    joined = incremental.stored_totals(spark, now.customers, now.buckets).groupBy("customer_id").count()
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_old_versions_go(spark, root):
    store = Store(root)
    for n in range(4):
        put(spark, store, "orders", orders_of(DAYS[0], 10 * n, 2), n)
        incremental.run(spark, store, "2026-06-01", buckets=2)
    assert len(os.listdir(f"{root}/state/customers")) == 2


def test_merged_totals_keep_the_latest_name(spark):
    def totals(*bodies):
        return customers.customer_totals(layers.TOPICS["orders"].clean(raw(spark, "orders", list(bodies))))

    a = totals(order(1, customer_id="A", customer_name="old", timestamp="2026-05-01T00:00:00"), order(2, customer_id="B", timestamp="no time", date="x"))
    b = totals(order(3, customer_id="A", customer_name="new", timestamp="2026-05-02T00:00:00"), order(4, customer_id="C", customer_name=None))
    found = {r["customer_id"]: r for r in customers.merged_totals(a, b).collect()}
    assert set(found) == {"A", "B", "C"}
    assert found["A"]["latest"]["customer_name"] == "new" and found["A"]["total_orders"] == 2 and int(found["A"]["cents"]) == 20000
    assert found["B"]["last_day"] is None
    swapped = {r["customer_id"]: r for r in customers.merged_totals(b, a).collect()}
    assert swapped == found


# -- bitmaps ----------------------------------------------------------------------
def test_distinct_customers_of_any_range(spark, root):
    store, seen = Store(root), []
    for n in range(3):
        bodies = [
            event(100 * n + i, customer_id=f"C{(i * 7 + n) % 50}", date=DAYS[(i + n) % 3], event_type=["PAGE_VIEW", "search"][i % 2],
                  device=["Mobile", "Desktop", "Tablet"][i % 3])
            for i in range(60)
        ]
        put(spark, store, "user_events", bodies, n)
        seen += bodies
        incremental.run(spark, store, "2026-06-01")
    for first, last in ((None, None), (DAYS[0], DAYS[1]), (DAYS[1], DAYS[1]), (DAYS[2], None), ("2030-01-01", None)):
        want = {}
        for e in seen:
            if (first or "") <= e["date"] <= (last or "9"):
                want.setdefault(e["event_type"].upper(), []).append(e)
        got = {r["event_type"]: r for r in incremental.event_funnel(spark, store, first, last).collect()}
        assert set(got) == set(want)
        for kind, events in want.items():
            assert got[kind]["unique_customers"] == len({e["customer_id"] for e in events})
            assert got[kind]["total_events"] == len(events)
            assert got[kind]["mobile_events"] == sum(e["device"] == "Mobile" for e in events)


def test_customers_beyond_one_bitmap(spark):
    """Numbers of several blocks of 32,768."""
    events = spark.range(100_000).select(
        F.lit("2026-05-16").alias("date"), F.lit("V").alias("event_type"), F.concat(F.lit("C"), F.col("id") % 70_000).alias("customer_id")
    )
    numbers = spark.range(70_000).select(F.concat(F.lit("C"), "id").alias("customer_id"), (F.col("id") + 1).alias("number"))
    daily = incremental.daily_event_customers(events, numbers)
    assert daily.count() == 3
    assert daily.agg(F.sum(F.bitmap_count("customers"))).first()[0] == 70_000


def test_a_range_reads_its_days_only(spark, root):
    store = Store(root)
    for n, day in enumerate(DAYS):
        put(spark, store, "user_events", [event(n, date=day)], n)
    incremental.run(spark, store, "2026-06-01")
    text = incremental.event_funnel(spark, store, DAYS[1], DAYS[1])._jdf.queryExecution().executedPlan().toString()
    assert text.count("PartitionFilters: [isnotnull(date") >= 2 and "curated" not in text


def _writers(folder):
    """Numbers of the tasks that wrote the files below a folder."""
    return {name.split("-")[1] for _, _, names in os.walk(folder) for name in names if name.startswith("part-")}


def test_days_and_dates_are_written_by_all_cores(spark, root):
    store, days = Store(root), [f"2026-05-{d:02d}" for d in range(1, 25)]
    put(spark, store, "orders", [o for n, day in enumerate(days) for o in orders_of(day, 10 * n, 2)], 0)
    incremental.run(spark, store, "2026-06-01", buckets=2)
    folder = incremental.daily_folder(store, "daily_sales")
    assert len(_writers(folder)) > 2
    assert sorted(os.listdir(folder))[-24:] == [f"date={d}" for d in days]
    assert all(sum(n.endswith(".parquet") for n in os.listdir(f"{folder}/date={d}")) == 1 for d in days)
    before = rows(layers.read_curated(spark, store, "orders").drop("items"))
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    folder = f"{store.curated('orders')}/compacted/generation=1"
    assert len(_writers(folder)) > 2
    assert all(sum(n.endswith(".parquet") for n in os.listdir(f"{folder}/date={d}")) == 1 for d in days)
    assert rows(layers.read_curated(spark, store, "orders").drop("items")) == before


def test_dates_beyond_one_task_are_rebalanced(spark, root, monkeypatch):
    monkeypatch.setattr(layers, "ONE_TASK", 1)
    store = Store(root)
    put(spark, store, "orders", orders_of(DAYS[0], 0, 9) + orders_of(DAYS[1], 20, 9), 0)
    layers.compact(spark, store.curated("orders"), TOPICS["orders"].curated)
    assert layers.read_curated(spark, store, "orders").count() == 18


def test_folders_are_listed_by_a_task_per_core_unless_the_session_says_otherwise(spark):
    from mercato.session import list_with_cores

    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    given = spark.conf.get(key)
    try:
        for there, then in (("10000", str(spark.sparkContext.defaultParallelism)), ("77", "77")):
            spark.conf.set(key, there)
            assert list_with_cores(spark).conf.get(key) == then
    finally:
        spark.conf.set(key, given)


def test_a_topic_is_built_without_the_others(spark):
    """Runs, layers and the warehouse of one topic wait for no other topic."""
    from mercato.workspace import Workspace

    w = Workspace(spark, "/root/testdata/sf0.001/./.")  # a folder of its own
    folders = lambda path: set(os.listdir(path)) if os.path.isdir(path) else set()
    try:
        runs = w.nightly_runs("user_events")
        assert folders(f"{runs.root}/raw") == {"user_events"} and folders(f"{w.root}/envelopes") == {"user_events"}
        database = w.warehouse("daily_sales")
        assert not folders(f"{w.root}/streamed/raw") and spark.table(f"{database}.daily_sales_summary").count() > 0
        w.warehouse("user_events")
        assert folders(f"{w.root}/streamed/curated") == {"user_events"}
        assert spark.table(f"{database}.user_events").count() == w.tables.user_events.count()
        assert w.warehouse() == database and folders(f"{w.root}/streamed/curated") == {"orders", "payments", "user_events"}
        assert spark.table(f"{database}.payments").count() == w.tables.payments.count()
        assert spark.table(f"{database}.customer_rfm").count() == w.tables.customer_rfm.count()
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS shop_{w.tag} CASCADE")
        w.release()
