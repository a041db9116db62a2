import os
import shutil

import pytest
from pyspark.sql import functions as F

from mercato.sources.envelope import kafka_options, parse_envelope, read_envelope_files, to_envelope
from mercato.streaming import layers, live
from mercato.streaming.layers import TOPICS, Store
from tests.helpers import curated, envelope, event, order, payment, raw

ONCE = {"availableNow": True}


def land(spark, folder, topic, bodies, first_offset=0):
    envelope(spark, topic, bodies, first_offset).coalesce(1).write.mode("append").parquet(folder)


def ingest(spark, folder, store, topic="orders", **settings):
    seen = []
    query = layers.start_topic(
        read_envelope_files(spark, folder, 1), TOPICS[topic], store, ONCE,
        report=lambda name, batch_id, counts: seen.append((name, batch_id, counts)), **settings
    )
    layers.await_all([query])
    return seen


def same_rows(a, b):
    columns = [c for c in a.columns if c not in ("processed_at", "items")]
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


BATCHES = [
    [order(1), order(2, final_amount=0)],
    [order(3, date="2026-05-16"), order(4, date="2026-05-17"), "broken"],
]


@pytest.mark.parametrize("tasks", [None, 3])
def test_stream_equals_batch(spark, root, tasks):
    store = Store(f"{root}/store")
    for i, bodies in enumerate(BATCHES):
        land(spark, f"{root}/in", "orders", bodies, i * 10)
    seen = ingest(spark, f"{root}/in", store, tasks=tasks)
    assert sorted(batch_id for _, batch_id, _ in seen) == [0, 1]
    assert sorted((c["received"], c["clean"], c["dropped"]) for _, _, c in seen) == [(2, 1, 1), (3, 2, 1)]
    everything = [b for bodies in BATCHES for b in bodies]
    stored = layers.read_curated(spark, store, "orders")
    expected = curated(spark, "orders", everything)
    assert stored.columns == expected.columns
    assert same_rows(stored.drop("kafka_offset"), expected.drop("kafka_offset"))
    assert layers.read_raw(spark, store, "orders").count() == 5


def test_restart_adds_nothing_and_new_files_add_their_rows(spark, root):
    store = Store(f"{root}/store")
    land(spark, f"{root}/in", "orders", BATCHES[0])
    ingest(spark, f"{root}/in", store)
    assert ingest(spark, f"{root}/in", store) == []
    land(spark, f"{root}/in", "orders", BATCHES[1], 10)
    ingest(spark, f"{root}/in", store)
    assert layers.read_raw(spark, store, "orders").count() == 5
    assert layers.read_curated(spark, store, "orders").count() == 3


def test_replayed_batch_replaces_itself(spark, root):
    store = Store(f"{root}/store")
    for i, bodies in enumerate(BATCHES):
        land(spark, f"{root}/in", "orders", bodies, i * 10)
    ingest(spark, f"{root}/in", store)
    commits = f"{store.checkpoint('orders')}/commits"
    for name in os.listdir(commits):
        if name.lstrip(".").startswith("1"):
            os.remove(f"{commits}/{name}")  # the last batch is not known as done any more
    assert len(ingest(spark, f"{root}/in", store)) == 1
    assert layers.read_raw(spark, store, "orders").count() == 5
    assert layers.read_curated(spark, store, "orders").count() == 3


def test_new_checkpoint_gets_a_new_run(spark, root):
    store = Store(f"{root}/store")
    land(spark, f"{root}/in", "orders", BATCHES[0])
    ingest(spark, f"{root}/in", store)
    first = layers.run_id(spark, store.checkpoint("orders"))
    shutil.rmtree(store.checkpoint("orders"))
    assert layers.run_id(spark, store.checkpoint("orders")) != first


def test_empty_batch_writes_nothing(spark, root):
    store = Store(root)
    nothing = raw(spark, "orders", [order(1)]).limit(0)
    counts = layers.write_batch(nothing, 0, TOPICS["orders"], store, "r")
    assert counts == {"received": 0, "clean": 0, "dropped": 0}
    assert not os.path.exists(store.raw("orders"))


def test_batch_crossing_midnight_fills_two_partitions(spark, root):
    store = Store(root)
    batch = raw(spark, "orders", [order(1, date="2026-05-16"), order(2, date="2026-05-17")])
    layers.write_batch(batch, 0, TOPICS["orders"], store, "r")
    folder = f"{store.curated('orders')}/batches/run=r/batch_id=0"
    assert sorted(d for d in os.listdir(folder) if "=" in d) == ["date=2026-05-16", "date=2026-05-17"]


def test_date_filter_reaches_the_partitions(spark, root):
    store = Store(root)
    batch = raw(spark, "orders", [order(1, date="2026-05-16"), order(2, date="2026-05-17")])
    layers.write_batch(batch, 0, TOPICS["orders"], store, "r")
    one_day = layers.read_curated(spark, store, "orders").filter("date = '2026-05-17'")
    assert dict(one_day.dtypes)["date"] == "string"
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one_day.count() == 1


def test_added_column_is_null_in_older_rows(spark, root):
    store = Store(root)
    topic = TOPICS["orders"]
    layers.write_batch(raw(spark, "orders", [order(1)]), 0, topic, store, "r")
    wider = raw(spark, "orders", [order(2)]).withColumn("coupon", F.lit("SAVE"))
    layers.write_batch(wider, 1, topic, store, "r")
    merged = layers.read_curated(spark, store, "orders", evolve=True)
    assert merged.columns[-1] == "coupon" and dict(merged.dtypes)["date"] == "string"
    assert {r["order_id"]: r["coupon"] for r in merged.collect()} == {"ORD1": None, "ORD2": "SAVE"}
    assert "coupon" not in layers.read_curated(spark, store, "orders").columns


def test_compaction_keeps_every_row_and_goes_on(spark, root):
    store = Store(root)
    topic, layer = TOPICS["orders"], store.curated("orders")
    for i in range(3):
        layers.write_batch(raw(spark, "orders", [order(10 * i + 1), order(10 * i + 2)]), i, topic, store, "r")
    before = layers.read_curated(spark, store, "orders").orderBy("order_id").collect()
    assert layers.compact(spark, layer, topic.curated, open_batches=1) == 1
    assert layers.read_curated(spark, store, "orders").orderBy("order_id").collect() == before
    assert layers.drop_covered_batches(spark, layer) == 2
    assert layers.read_curated(spark, store, "orders").orderBy("order_id").collect() == before
    assert layers.read_curated(spark, store, "orders", evolve=True).count() == 6
    layers.write_batch(raw(spark, "orders", [order(50)]), 3, topic, store, "r")
    assert layers.compact(spark, layer, topic.curated) == 2
    assert layers.compact(spark, layer, topic.curated) == 2  # nothing new
    assert layers.read_curated(spark, store, "orders").count() == 7
    assert layers.drop_covered_batches(spark, layer) == 2
    assert layers.read_curated(spark, store, "orders", evolve=True).count() == 7
    assert not os.path.exists(f"{layer}/compacted/generation=1")  # its date was rewritten
    files = [f for f in os.listdir(f"{layer}/compacted/generation=2/date=2026-05-16") if f.endswith(".parquet")]
    assert len(files) == 1


def test_unfinished_compaction_is_ignored(spark, root):
    store = Store(root)
    topic, layer = TOPICS["orders"], store.curated("orders")
    layers.write_batch(raw(spark, "orders", [order(1)]), 0, topic, store, "r")
    layers.compact(spark, layer, topic.curated)
    shutil.copytree(f"{layer}/compacted/generation=1", f"{layer}/compacted/generation=2")
    assert layers.read_curated(spark, store, "orders").count() == 1


def test_batch_in_writing_is_not_compacted(spark, root):
    store = Store(root)
    topic, layer = TOPICS["orders"], store.curated("orders")
    for i in range(2):
        layers.write_batch(raw(spark, "orders", [order(i)]), i, topic, store, "r")
    os.remove(f"{layer}/batches/run=r/batch_id=1/_SUCCESS")
    layers.compact(spark, layer, topic.curated)
    assert layers._covered(spark, layer)["runs"] == {"r": 0}


def test_three_topics_side_by_side(spark, root):
    store = Store(f"{root}/store")
    land(spark, f"{root}/in/orders", "orders", [order(1)])
    land(spark, f"{root}/in/payments", "payments", [payment(1), payment(2, amount=None)])
    land(spark, f"{root}/in/user_events", "user_events", [event(1)])
    queries = layers.start_all(
        lambda t: read_envelope_files(spark, f"{root}/in/{t}"), store, trigger=ONCE
    )
    layers.await_all(queries)
    counts = layers.batch_counts(spark, store, "payments").first()
    assert (counts["received"], counts["clean"], counts["dropped"]) == (2, 1, 1)
    assert all(layers.read_curated(spark, store, t).count() == 1 for t in TOPICS)


def test_failure_of_one_query_stops_the_others(spark, root):
    land(spark, f"{root}/in", "orders", [order(1)])
    bad = read_envelope_files(spark, f"{root}/in").select(F.raise_error(F.lit("boom")).alias("x"))
    failing = bad.writeStream.format("noop").option("checkpointLocation", f"{root}/c1").start()
    steady = layers.start_topic(read_envelope_files(spark, f"{root}/in"), TOPICS["orders"], Store(f"{root}/s"))
    with pytest.raises(Exception, match="boom"):
        layers.await_all([steady, failing], poll_seconds=0.2)
    assert not steady.isActive


def test_running_counts_grow(spark, root):
    land(spark, f"{root}/in", "orders", [order(1), order(2)])
    land(spark, f"{root}/in", "payments", [payment(1)])
    query = live.start_watch(
        live.topic_counts(read_envelope_files(spark, f"{root}/in")), "counts_test", "memory", "complete",
        {"processingTime": "0 seconds"},
    )
    query.processAllAvailable()
    assert {r[0]: r[1] for r in spark.table("counts_test").collect()} == {"orders": 2, "payments": 1}
    land(spark, f"{root}/in", "payments", [payment(2)])
    query.processAllAvailable()
    assert {r[0]: r[1] for r in spark.table("counts_test").collect()} == {"orders": 2, "payments": 2}
    query.stop()


def test_watch_views(spark):
    row = live.watch_orders(raw(spark, "orders", [order(1, final_amount=1234.5, discount=None)])).first()
    assert row["amount"] == "₹1,234.50" and row["discount"] == "₹0.00"
    assert row["products"] == "Yoga Mat Premium x2" and row["customer"] == "A Name (a@example.com)"
    assert row["line"] == "ORDER | ORD1 | A Name               |   ₹1,234.50 | Kochi"
    assert live.watch_payments(raw(spark, "payments", [payment(1)])).first()["method"] == "UPI via PayU"
    missing = live.watch_user_events(raw(spark, "user_events", [event(1, product_name=None)])).first()
    assert missing["product"] == "N/A"


def test_envelope_round_trip(spark):
    records = spark.createDataFrame([("ORD1", 5, 2.5)], "order_id string, num_items int, final_amount double")
    packed = to_envelope(records, "orders", "order_id", records.columns, F.lit(0), F.lit(7))
    assert packed.first()["key"] == b"ORD1"
    back = parse_envelope(packed, TOPICS["orders"].record).first()
    assert (back["order_id"], back["num_items"], back["final_amount"], back["kafka_offset"]) == ("ORD1", 5, 2.5, 7)
    assert back["customer_id"] is None


def test_kafka_options():
    assert kafka_options("orders", "host:9092") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "orders", "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    several = kafka_options(["orders", "payments"], "h:1", max_per_trigger=1000)
    assert several["subscribe"] == "orders,payments" and several["maxOffsetsPerTrigger"] == "1000"
