"""Live views of topics: running counts and the fields an operator watches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercato import schemas
from mercato.functions.text import (
    items_label, or_missing, pad_left, pad_right, place_label, rupee_cents_label,
)
from mercato.session import fresh_path


def topic_counts(envelope: DataFrame) -> DataFrame:
    """Messages per topic; on a stream, running totals kept as state."""
    return envelope.groupBy("topic").agg(F.count("*").alias("messages"))


def watch_orders(records: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit("ORDER | "), F.col("order_id"), F.lit(" | "), pad_right(F.col("customer_name"), 20),
        F.lit(" | "), pad_left(rupee_cents_label("final_amount"), 11), F.lit(" | "), F.col("city"),
    )
    return records.select(
        "kafka_partition",
        "kafka_offset",
        "order_id",
        place_label("customer_name", "customer_email").alias("customer"),
        place_label("city", "region").alias("place"),
        rupee_cents_label("final_amount").alias("amount"),
        rupee_cents_label(F.coalesce("discount", F.lit(0.0))).alias("discount"),
        "num_items",
        "device",
        F.coalesce(items_label("items"), F.lit("")).alias("products"),
        line.alias("line"),
    )


def watch_payments(records: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit("PAYMENT | "), F.col("payment_id"), F.lit(" | "), pad_right(F.col("payment_method"), 15),
        F.lit(" | "), pad_left(rupee_cents_label("amount"), 11), F.lit(" | "), F.col("status"),
    )
    return records.select(
        "kafka_partition",
        "kafka_offset",
        "payment_id",
        "order_id",
        rupee_cents_label("amount").alias("amount"),
        F.concat(F.col("payment_method"), F.lit(" via "), F.col("gateway")).alias("method"),
        "status",
        line.alias("line"),
    )


def watch_user_events(records: DataFrame) -> DataFrame:
    line = F.concat(
        F.lit("USER EVENT | "), F.col("event_id"), F.lit(" | "), pad_right(F.col("event_type"), 20),
        F.lit(" | "), F.col("customer_id"), F.lit(" | "), F.col("device"),
    )
    return records.select(
        "kafka_partition",
        "kafka_offset",
        "event_id",
        "event_type",
        "customer_id",
        or_missing("product_name").alias("product"),
        "device",
        line.alias("line"),
    )


WATCH = dict(zip(schemas.TOPICS, (watch_orders, watch_payments, watch_user_events)))


def start_watch(
    view: DataFrame, name: str, sink: str = "console", mode: str = "append", trigger: dict | None = None
) -> StreamingQuery:
    """Send a live view to the console, or to an in-memory table for small results.

    Offsets and running counts go to the shared folder: by default these sinks would keep
    them in a temporary folder that other machines do not see.
    """
    checkpoint = fresh_path(view.sparkSession, f"watch-{name}")
    writer = view.writeStream.format(sink).queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint).option("truncate", "false")
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
