"""Streams with state: repeated deliveries, and payments that meet their orders."""

import json
import os
from datetime import datetime, timedelta

import pytest

from mercato import schemas, workspace
from mercato.operators.quality import deduplicate
from mercato.sources.envelope import read_envelope_files
from mercato.sources.files import Files
from mercato.streaming import layers, stateful
from mercato.streaming.layers import TOPICS, Store
from tests.helpers import envelope, order, payment, shop_tables

ONCE = {"availableNow": True}
START = datetime(2026, 5, 16, 10)


def land(spark, folder, topic, messages):
    """Messages as (body, hours after the start); offsets go on from landing to landing."""
    rows = []
    for body, hours in messages:
        at = None if hours is None else START + timedelta(hours=hours)
        rows.append((None, bytearray(json.dumps(body).encode()), topic, 0, len(rows), at, 0))
    spark.createDataFrame(rows, schemas.ENVELOPE).coalesce(1).write.mode("append").parquet(folder)


def run_unique(spark, folder, store, within="24 hours"):
    query = stateful.start_unique(read_envelope_files(spark, folder), TOPICS["payments"], store, within, ONCE)
    layers.await_all([query])
    return stateful.state_report(query)


def ids(df, key="payment_id"):
    return sorted(r[0] for r in df.select(key).collect())


def test_replays_of_later_batches_are_dropped_and_state_is_let_go(spark, root):
    store, folder = Store(f"{root}/store"), f"{root}/in"
    land(spark, folder, "payments", [(payment(i), i * 0.1) for i in range(10)])
    first = run_unique(spark, folder, store)
    assert max(r["state_rows"] for r in first) == 10
    # five come again, as they were, in a later batch; three are new; one comes twice at once
    again = [(payment(i), 5) for i in range(5)] + [(payment(i), 6) for i in (10, 11, 12, 12)]
    land(spark, folder, "payments", again)
    second = run_unique(spark, folder, store)
    assert sum(r["repeats"] for r in second) == 6
    assert ids(stateful.read_unique(spark, store, "payments")) == sorted(f"PAY{i}" for i in range(13))
    # days later nothing of them is kept
    land(spark, folder, "payments", [(payment(20), 100)])
    third = run_unique(spark, folder, store)
    assert third[-1]["state_rows"] <= 1 and sum(r["released"] for r in third) >= 13
    assert ids(stateful.read_unique(spark, store, "payments")) == sorted(f"PAY{i}" for i in [*range(13), 20])
    # a restart without new messages adds nothing
    run_unique(spark, folder, store)
    assert stateful.read_unique(spark, store, "payments").count() == 14


def test_a_date_is_written_by_few_tasks_however_many_hold_state(spark, root):
    store, folder = Store(f"{root}/store"), f"{root}/in"
    days = [f"2026-05-{d:02d}" for d in range(1, 11)]
    land(spark, folder, "payments", [(payment(40 * n + i, date=day), n) for n, day in enumerate(days) for i in range(40)])
    run_unique(spark, folder, store)
    files = [n for _, _, names in os.walk(store.unique("payments")) for n in names if n.endswith(".parquet")]
    assert len(files) <= len(days) + spark.sparkContext.defaultParallelism
    assert ids(stateful.read_unique(spark, store, "payments")) == sorted(f"PAY{i}" for i in range(400))


def test_rows_behind_the_watermark_are_recovered(spark, root):
    store, folder = Store(f"{root}/store"), f"{root}/in"
    for messages in ([(payment(1), 0), (payment(2), 90)], [(payment(3), 1), (payment(3), 2), (payment(1), 1), (payment(4), 91)]):
        land(spark, folder, "payments", messages)
        report = run_unique(spark, folder, store)
        raw = layers.start_topic(read_envelope_files(spark, folder), TOPICS["payments"], store, ONCE)
        layers.await_all([raw])
    assert sum(r["late"] for r in report) == 3  # two of a new id, one a repeat
    assert ids(stateful.read_unique(spark, store, "payments")) == ["PAY1", "PAY2", "PAY4"]
    assert stateful.recover_late(spark, store, TOPICS["payments"]) == 1
    assert ids(stateful.read_unique(spark, store, "payments")) == ["PAY1", "PAY2", "PAY3", "PAY4"]
    assert stateful.recover_late(spark, store, TOPICS["payments"]) == 0


def test_invalid_and_undated_messages(spark, root):
    store, folder = Store(f"{root}/store"), f"{root}/in"
    bodies = [(payment(1), None), (payment(1), None), (payment(2, amount=0), 0), ("no record", 0), (payment(3, payment_id=" pay3 "), 0), (payment(3), 1)]
    land(spark, folder, "payments", bodies)
    run_unique(spark, folder, store)
    assert ids(stateful.read_unique(spark, store, "payments")) == ["PAY1", "PAY3"]


def test_state_in_rocksdb(spark, root):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.state_on_disk(spark)
    try:
        store, folder = Store(f"{root}/store"), f"{root}/in"
        for hours in (0, 5):
            land(spark, folder, "payments", [(payment(i), hours) for i in range(4)])
            report = run_unique(spark, folder, store)
        assert sum(r["repeats"] for r in report) == 4
        assert stateful.read_unique(spark, store, "payments").count() == 4
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


# -- payments and orders --------------------------------------------------------
def stamp(hours):
    return None if hours is None else (START + timedelta(hours=hours)).isoformat()


def run_reconciled(spark, root, store):
    query = stateful.start_reconciliation(lambda t: read_envelope_files(spark, f"{root}/in/{t}"), store, ONCE)
    layers.await_all([query])
    return {(r["order_id"], r["payment_id"]): r["status"] for r in stateful.read_reconciled(spark, store).collect()}, stateful.state_report(query)


def at(make, i, hours, **changes):
    return make(i, timestamp=stamp(hours), **changes), hours


def test_payments_meet_their_orders(spark, root):
    store = Store(f"{root}/store")
    land(spark, f"{root}/in/orders", "orders", [
        at(order, 1, 0), at(order, 2, 0), at(order, 3, 0), at(order, 4, 0), at(order, 5, 1), at(order, 6, 1), at(order, 7, 0),
    ])
    land(spark, f"{root}/in/payments", "payments", [
        at(payment, 1, 0.5), at(payment, 2, 1, amount=99.0), at(payment, 3, 1, customer_id="CUST9"), at(payment, 8, 1),
        at(payment, 7, -0.5), at(payment, 1, 0.5),
    ])
    found, report = run_reconciled(spark, root, store)
    assert found == {
        ("ORD1", "PAY1"): "OK", ("ORD2", "PAY2"): "AMOUNT_MISMATCH", ("ORD3", "PAY3"): "CUSTOMER_MISMATCH", ("ORD7", "PAY7"): "OK",
    }  # the others may still find a partner
    assert report[-1]["state_rows"] > 0
    # a day later: one payment in time, one two days too late, repeats of what has met
    land(spark, f"{root}/in/orders", "orders", [at(order, 9, 70), at(order, 2, 0.2)])
    land(spark, f"{root}/in/payments", "payments", [at(payment, 5, 30), at(payment, 6, 60), at(payment, 9, 71)])
    found, _ = run_reconciled(spark, root, store)
    assert found[("ORD5", "PAY5")] == "OK" and found[("ORD9", "PAY9")] == "OK"
    # both streams go on: the watermark releases what stayed alone, and the state
    for topic, make in (("orders", order), ("payments", payment)):
        land(spark, f"{root}/in/{topic}", topic, [at(make, 99, 500)])
    found, report = run_reconciled(spark, root, store)
    assert found.pop(("ORD99", "PAY99")) == "OK"
    assert {k: v for k, v in found.items() if v.endswith(("PAYMENT", "ORDER"))} == {
        ("ORD4", None): "ORDER_WITHOUT_PAYMENT", ("ORD6", None): "ORDER_WITHOUT_PAYMENT",
        ("ORD6", "PAY6"): "PAYMENT_WITHOUT_ORDER", ("ORD8", "PAY8"): "PAYMENT_WITHOUT_ORDER",
    }
    assert len(found) == 10
    assert report[-1]["state_rows"] <= 4  # the last order and payment, told apart and waiting


@pytest.mark.parametrize("side", ["orders", "payments"])
def test_records_without_time_pass_at_once(spark, root, side):
    store = Store(f"{root}/store")
    for topic, make in (("orders", order), ("payments", payment)):
        land(spark, f"{root}/in/{topic}", topic, [at(make, 1, 0), at(make, 2, None if topic == side else 0)])
    found, _ = run_reconciled(spark, root, store)
    alone = ("ORD2", None) if side == "orders" else ("ORD2", "PAY2")
    assert found == {("ORD1", "PAY1"): "OK", alone: "NO_TIME"}


def test_the_stream_gives_what_a_batch_gives(spark):
    from tests.helpers import curated

    orders = curated(spark, "orders", [order(1), order(2), order(3, timestamp="2026-05-18T10:11:13")])
    payments = curated(spark, "payments", [payment(1), payment(3), payment(4)])
    got = {(r["order_id"], r["payment_id"], r["status"]) for r in stateful.met_payments(orders, payments).collect()}
    assert got == {
        ("ORD1", "PAY1", "OK"), ("ORD2", None, "ORDER_WITHOUT_PAYMENT"), ("ORD3", None, "ORDER_WITHOUT_PAYMENT"),
        ("ORD3", "PAY3", "PAYMENT_WITHOUT_ORDER"), ("ORD4", "PAY4", "PAYMENT_WITHOUT_ORDER"),
    }


def test_records_without_time_are_found_by_that_field_alone(spark):
    bodies = [
        payment(1), payment(2, timestamp=None), payment(3, timestamp="soon"), payment(4, timestamp=20260516), payment(5, timestamp=""),
        {k: v for k, v in payment(6).items() if k != "timestamp"}, payment(7, amount="much"), "no record", None, "[1]",
        '{"timestamp": "2026-05-16T10:11:12", "payment_id": "PAY8", "order_id": "ORD8", "amount": 1, "timestamp": null}',
        payment(9, timestamp=None, amount="much"), payment(10, timestamp={"at": 1}),
    ]
    messages, topic = envelope(spark, "payments", bodies), TOPICS["payments"]
    untimed = lambda rows: ids(stateful.curated_stream(rows, topic).where("event_timestamp IS NULL"))
    found = untimed(stateful.without_time(messages))
    assert found == untimed(messages) and {"PAY2", "PAY3", "PAY5", "PAY6", "PAY8"} <= set(found)
    assert "PAY1" not in ids(stateful.curated_stream(stateful.without_time(messages), topic))


def test_state_is_dealt_out_over_so_many_tasks(spark, root):
    store, before = Store(f"{root}/store"), spark.conf.get("spark.sql.shuffle.partitions")
    for topic, make in (("orders", order), ("payments", payment)):
        land(spark, f"{root}/in/{topic}", topic, [at(make, i, 0) for i in range(20)])
    query = stateful.start_reconciliation(lambda t: read_envelope_files(spark, f"{root}/in/{t}"), store, ONCE, tasks=3)
    layers.await_all([query])
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    held = os.listdir(f"{store.checkpoint('reconciled')}/state/0")
    assert sorted(n for n in held if n.isdigit()) == ["0", "1", "2"]
    assert stateful.read_reconciled(spark, store).where("status = 'OK'").count() == 20


def test_a_landing_of_years_is_read_in_batches_in_order_of_arrival(spark, root, monkeypatch):
    """What waits as state is then a batch and some days, however much lands at once; no row comes late for it."""
    monkeypatch.setattr(workspace, "BATCH_ROWS", 75, raising=False)
    monkeypatch.setattr(workspace, "BATCH_FILES", 1, raising=False)
    shop = workspace.Workspace(spark, shop_tables(f"{root}/tables"))
    try:
        store = shop.reconciled_payments()
        batches = [n for _, names, _ in os.walk(store.reconciled()) for n in names if n.startswith("batch_id=")]
        assert len(batches) >= 12  # 8, when a landing is a batch and another one lets go of what waits
        messages = {t: spark.read.schema(schemas.ENVELOPE).parquet(f"{shop.root}/landed_reconciled/{t}") for t in ("orders", "payments")}
        sides = [deduplicate(stateful.curated_stream(messages[t], TOPICS[t]).drop("items", "processed_at"), TOPICS[t].key) for t in messages]
        rows = lambda df: sorted(map(str, df.select("order_id", "payment_id", "ordered_at", "paid_at", "order_amount", "status").collect()))
        found = stateful.read_reconciled(spark, store)
        assert rows(found) == rows(stateful.met_payments(*sides))
        assert {r["status"] for r in found.select("status").distinct().collect()} == {
            "OK", "AMOUNT_MISMATCH", "ORDER_WITHOUT_PAYMENT", "PAYMENT_WITHOUT_ORDER", "NO_TIME"
        }
        assert not os.path.exists(f"{shop.root}/orders") and not os.path.exists(f"{shop.root}/payments")  # no copy on the way
    finally:
        shop.release()


def test_files_land_with_the_time_they_are_given(spark, root):
    files = Files(spark)
    files.publish_text(f"{root}/out/a", "text")
    assert files.move(f"{root}/out/a", f"{root}/in/b", 1_000_000_000_123)
    assert os.stat(f"{root}/in/b").st_mtime_ns // 1_000_000 == 1_000_000_000_123 and not os.path.exists(f"{root}/out/a")
    files.publish_text(f"{root}/in/c", "other")
    assert files.read_text(f"{root}/in/b") == "text"
