"""Streams that remember: repeated deliveries dropped as they arrive, payments met with their orders.

Both keep what they have seen as state keyed by id, let go of by an event-time watermark, so the
state holds a window of the stream and not its history. State is dealt out by id over
``spark.sql.shuffle.partitions`` tasks, a number fixed when a query first starts; :func:`state_on_disk`
keeps it in RocksDB, for windows that exceed the executors' memory. A restarted query goes on from
its checkpoint with state and watermark as they were.

Results are written as the other layers are: each batch overwrites a folder of its own, so a replayed
batch replaces its earlier attempt.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercato.functions.money import cents, from_cents
from mercato.operators.quality import deduplicate
from mercato.sources.envelope import parse_envelope
from mercato.streaming import layers
from mercato.streaming.layers import TOPICS, Store, Topic, run_id

#: Columns of the stored reconciliation.
RECONCILED = (
    "order_id string, payment_id string, customer_id string, ordered_at timestamp, paid_at timestamp, "
    "order_amount double, paid_amount double, status string"
)


def state_on_disk(spark: SparkSession) -> SparkSession:
    """State of queries started from now on is kept in RocksDB; only changes go to the checkpoint."""
    name = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", name)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def curated_stream(envelope: DataFrame, topic: Topic) -> DataFrame:
    """Valid, tidy records of a topic; a projection, so it runs on streams and batches alike."""
    return topic.clean(parse_envelope(envelope, topic.record, once=True))


# -- repeated deliveries ------------------------------------------------------
def first_deliveries(records: DataFrame, key: str, within: str, at: str = "kafka_timestamp") -> DataFrame:
    """One row per id: further deliveries up to ``within`` after the first are dropped.

    Both copies of one batch are seen at once and either may stay. A delivery older than the
    watermark (the newest so far less ``within``) is dropped as late, whether it is a copy or not;
    :func:`recover_late` brings back those that are none. One that comes later than ``within`` after
    its first is taken for new. Rows without delivery time are told apart within a batch only.
    """
    return records.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def start_unique(
    envelope: DataFrame, topic: Topic, store: Store, within: str, trigger: dict | None = None, tasks: int | None = None
) -> StreamingQuery:
    """Envelope -> the topic's unique layer, beside the raw layer, which keeps every delivery.

    State deals rows out by id, so each of its tasks would write a file per date. ``tasks`` (the cores,
    unless given) range them by date and offset first, as :func:`layers.write_batch` does.
    """
    rows = first_deliveries(curated_stream(envelope, topic), topic.key, within)
    return _start(rows, store.unique(topic.name), f"{store.checkpoint(topic.name)}-unique", trigger, by_date=True, tasks=tasks)


def read_unique(spark: SparkSession, store: Store, topic: str) -> DataFrame:
    return layers.read_layer(spark, store.unique(topic), TOPICS[topic].curated, by_date=True)


def recover_late(spark: SparkSession, store: Store, topic: Topic) -> int:
    """Add records of the raw layer that the unique layer lacks; returns how many.

    Those are the ones that came behind the watermark. One row per id, the earliest delivered. A
    batch job for quiet hours: the layer's ids are joined, not held.
    """
    known = read_unique(spark, store, topic.name).select(topic.key)
    raw = topic.clean(layers.read_raw(spark, store, topic.name))
    stamped = [c for c in ("processed_at",) if c in raw.columns]
    lost = deduplicate(raw.drop(*stamped).join(known, topic.key, "left_anti"), topic.key)
    lost = lost.withColumns({c: F.current_timestamp() for c in stamped}).select(*raw.columns)
    folder = f"{store.unique(topic.name)}/batches/run=late-{uuid.uuid4().hex[:12]}/batch_id=0"
    layers.write_rows(lost, folder, by_date=True)
    return layers.scan_batch(spark, folder, topic.curated).count()


# -- payments and orders ------------------------------------------------------
def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def met_payments(
    orders: DataFrame, payments: DataFrame, lateness: str = "1 day", early: str = "1 hour", within: str = "2 days",
    maybe_untimed: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Each order with its payment, as soon as both are there, and what stays alone, once it must.

    A payment belongs to the order of its id if it is made at most ``early`` before and ``within``
    after it. Repeats of an id are dropped first. Both sides wait as state until the watermark of the
    slower stream (its newest event less ``lateness``) has passed the last time at which a partner
    could still come; then they are released as ORDER_WITHOUT_PAYMENT or PAYMENT_WITHOUT_ORDER.
    Records without event time cannot wait for anything and pass at once as NO_TIME, repeats, too.
    On batches the same rows come out, all of them. ``maybe_untimed`` gives orders and payments among which
    are all those without event time, where they are found with less work than in the whole streams.
    """
    timed = F.col("event_timestamp").isNotNull()
    sides = []
    for df, key in ((orders, "order_id"), (payments, "payment_id")):
        known = df.where(timed)
        if df.isStreaming:
            known = known.withWatermark("event_timestamp", lateness).dropDuplicatesWithinWatermark([key])
        sides.append(known)
    o = sides[0].select(
        "order_id", F.col("customer_id").alias("ordered_by"), F.col("event_timestamp").alias("ordered_at"),
        cents("final_amount").alias("order_cents"),
    )
    p = sides[1].select(
        "payment_id", F.col("order_id").alias("paid_order"), F.col("customer_id").alias("paid_by"),
        F.col("event_timestamp").alias("paid_at"), cents("amount").alias("paid_cents"),
    )
    belongs = (
        (F.col("order_id") == F.col("paid_order"))
        & (F.col("paid_at") >= F.col("ordered_at") - _interval(early))
        & (F.col("paid_at") <= F.col("ordered_at") + _interval(within))
    )
    both = o.join(p, belongs, "full_outer")
    status = (
        F.when(F.col("paid_order").isNull(), "ORDER_WITHOUT_PAYMENT")
        .when(F.col("order_id").isNull(), "PAYMENT_WITHOUT_ORDER")
        .when(F.col("order_cents") != F.col("paid_cents"), "AMOUNT_MISMATCH")
        .when(~F.col("ordered_by").eqNullSafe(F.col("paid_by")), "CUSTOMER_MISMATCH")
        .otherwise("OK")
    )
    met = both.select(
        F.coalesce("order_id", "paid_order").alias("order_id"), "payment_id",
        F.coalesce("ordered_by", "paid_by").alias("customer_id"), "ordered_at", "paid_at",
        from_cents(F.col("order_cents")).alias("order_amount"), from_cents(F.col("paid_cents")).alias("paid_amount"),
        status.alias("status"),
    )
    time, text, amount = (F.lit(None).cast(t) for t in ("timestamp", "string", "double"))
    among_orders, among_payments = maybe_untimed or (orders, payments)
    untimed_orders = among_orders.where(~timed).select(
        "order_id", text.alias("payment_id"), "customer_id", time.alias("ordered_at"), time.alias("paid_at"),
        from_cents(cents("final_amount")).alias("order_amount"), amount.alias("paid_amount"), F.lit("NO_TIME").alias("status"),
    )
    untimed_payments = among_payments.where(~timed).select(
        "order_id", "payment_id", "customer_id", time.alias("ordered_at"), time.alias("paid_at"),
        amount.alias("order_amount"), from_cents(cents("amount")).alias("paid_amount"), F.lit("NO_TIME").alias("status"),
    )
    return met.unionByName(untimed_orders).unionByName(untimed_payments)


def without_time(envelope: DataFrame) -> DataFrame:
    """Messages whose event time is none, those of no valid JSON included; parses that field alone."""
    time = F.from_json(F.col("value").cast("string"), "timestamp string")["timestamp"]
    return envelope.where(time.try_cast("timestamp").isNull())


def start_reconciliation(
    envelope_of: Callable[[str], DataFrame], store: Store, trigger: dict | None = None, tasks: int | None = None, **times: str
) -> StreamingQuery:
    """Both topics -> the stored reconciliation.

    A task keeps six tables of state, which cost files with every batch however few rows they have; ``tasks``
    is how many hold it when the query first starts, else the session's number of shuffle partitions.
    """
    sides, untimed = [], []
    for name in ("orders", "payments"):
        envelope = envelope_of(name)
        sides.append(curated_stream(envelope, TOPICS[name]))
        untimed.append(curated_stream(without_time(envelope), TOPICS[name]))
    rows = met_payments(*sides, **times, maybe_untimed=tuple(untimed))
    conf, key = rows.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    try:  # a query keeps the settings that its session has at its start
        conf.set(key, tasks or before)
        return _start(rows, store.reconciled(), store.checkpoint("reconciled"), trigger, by_date=False)
    finally:
        conf.set(key, before)


def read_reconciled(spark: SparkSession, store: Store) -> DataFrame:
    return layers.read_layer(spark, store.reconciled(), RECONCILED)


# -- running ------------------------------------------------------------------
def _start(rows: DataFrame, layer: str, checkpoint: str, trigger: dict | None, by_date: bool, tasks: int | None = None) -> StreamingQuery:
    run = run_id(rows.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = layers.batch_folder(layer, run, batch_id)
        if not by_date:
            return layers.write_rows(batch, folder, by_date)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # ranges are found in a pass of their own, and state moves on once
        try:
            cores = batch.sparkSession.sparkContext.defaultParallelism
            ranged = batch.repartitionByRange(tasks or cores, "date", "kafka_partition", "kafka_offset")
            layers.write_rows(ranged, folder, by_date)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(f"{layer.rsplit('/', 1)[-1]}_{uuid.uuid4().hex[:8]}")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def state_report(query: StreamingQuery) -> list[dict]:
    """Per batch, from the query's progress: its watermark, rows kept as state, rows let go of,
    repeats dropped, and rows dropped as late."""
    out = []
    for p in query.recentProgress:
        operators = p["stateOperators"]
        out.append(
            {
                "batch_id": p["batchId"],
                "watermark": p["eventTime"].get("watermark") if p["eventTime"] else None,
                "state_rows": sum(s["numRowsTotal"] for s in operators),
                "released": sum(s["numRowsRemoved"] for s in operators),
                "repeats": sum(s["customMetrics"].get("numDroppedDuplicateRows", 0) for s in operators),
                "late": sum(s["numRowsDroppedByWatermark"] for s in operators),
            }
        )
    return out
