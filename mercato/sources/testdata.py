"""Shop messages derived from the star-schema test tables.

Each function maps whole tables to one message shape. Nothing is filtered; the odd rows
(orders without lines, null or zero discounts, padded lower-case ids) come out of the data.

``items`` stays null on orders: gathering lines into one array would put a hot order into
one task. Line-level work reads :func:`order_lines`, one row per line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import schemas
from mercato.functions.money import cents, from_cents, total_cents
from mercato.sources.envelope import to_envelope

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(number: Column, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def _order_time() -> Column:
    """Order day plus a spread over the hours of the day."""
    return F.expr("cast(timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate) as timestamp)")


def _delivery(topic: str, key: Column, at: Column) -> list[Column]:
    return [
        F.lit(topic).alias("kafka_topic"),
        (key % 4).cast("int").alias("kafka_partition"),
        F.call_function("div", key, F.lit(4)).alias("kafka_offset"),
        at.alias("kafka_timestamp"),
    ]


def _null_items() -> Column:
    struct = schemas.LINE_ITEM.replace(" string", ":string").replace(" double", ":double").replace(" int", ":int")
    return F.lit(None).cast(f"array<struct<{struct}>>")


def line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per order; partial aggregation keeps a hot order from being one big group."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").cast("int").alias("num_items"),
            from_cents(total_cents("l_extendedprice")).alias("subtotal"),
        )
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("n_nationkey", "n_name", "r_name")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "c_name", "n_name", "r_name")
    )
    # The unique-key join runs first on narrow rows, the customer join last: customer keys
    # may be hot, and there adaptive execution can split the order side of a left join.
    joined = (
        table(spark, sf_dir, "orders")
        .join(line_totals(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    k, at = F.col("o_orderkey"), _order_time()
    status = (
        F.when(k % 20 == 0, "CANCELLED")
        .when(F.col("o_orderstatus") == "F", "DELIVERED")
        .when(F.col("o_orderstatus") == "O", "PLACED")
        .otherwise("PROCESSING")
    )
    discount = F.when(k % 7 == 0, F.lit(None)).when((k % 7).isin(1, 2, 3), 0.0).otherwise((k % 5000).cast("double"))
    return joined.select(
        F.concat(F.lit(" ord"), k, F.lit(" ")).alias("order_id"),
        F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("customer_name"),
        F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@example.com")).alias("customer_email"),
        F.lit("0000000000").alias("customer_phone"),
        F.concat(F.lit(" "), F.lower("r_name")).alias("region"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("city"),
        F.lit("unlisted").alias("address"),
        "num_items",
        "subtotal",
        discount.alias("discount"),
        F.col("o_totalprice").alias("final_amount"),
        _pick(k, schemas.DEVICES).alias("device"),
        status.alias("status"),
        F.date_format(at, ISO_SECONDS).alias("timestamp"),
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        (k % 24).cast("int").alias("hour"),
        _null_items().alias("items"),
        *_delivery("orders", k, at),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order row."""
    k, at = F.col("o_orderkey"), _order_time()
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit(" pay"), k).alias("payment_id"),
        F.concat(F.lit(" ord"), k, F.lit(" ")).alias("order_id"),
        F.concat(F.lit("CUST"), F.col("o_custkey")).alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        _pick(F.call_function("div", k, F.lit(3)), schemas.PAYMENT_METHODS).alias("payment_method"),
        F.when(F.col("o_orderstatus").isNull(), None)
        .when(F.call_function("div", k, F.lit(7)) % 10 == 0, "FAILED").otherwise("success").alias("status"),
        _pick(k, schemas.GATEWAYS).alias("gateway"),
        F.concat(F.lit("TXN"), k).alias("transaction_id"),
        F.date_format(at, ISO_SECONDS).alias("timestamp"),
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        *_delivery("payments", k, at),
    )


def raw_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {
        "view": "page_view", "click": "product_click", "purchase": "checkout_start",
        "signup": "search", "error": "remove_from_cart",
    }
    kind = F.col("event_type")
    mapped = F.element_at(F.create_map(*[F.lit(v) for pair in kinds.items() for v in pair]), kind)
    search = kind == "signup"
    number = F.get_json_object("props", "$.k")
    e, at = F.col("event_id"), F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt"), e).alias("event_id"),
        F.concat(F.lit("CUST"), F.col("user_id")).alias("customer_id"),
        mapped.alias("event_type"),
        F.when(~search, F.concat(F.lit("P"), number)).alias("product_id"),
        F.when(~search, F.concat(F.lit("product "), number)).alias("product_name"),
        F.when(~search, F.concat(F.lit("category "), (number.cast("int") % 6).cast("string"))).alias("category"),
        F.when(search, F.concat(F.lit("q"), number)).alias("search_query"),
        _pick(e, schemas.DEVICES).alias("device"),
        F.concat(F.lit("SES"), F.col("user_id")).alias("session_id"),
        F.concat(F.lit("/product/p"), number).alias("page_url"),
        F.date_format(at, ISO_MICROS).alias("timestamp"),
        F.date_format(at, "yyyy-MM-dd").alias("date"),
        *_delivery("user_events", e, at),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, in the shape of an exploded ``items`` array."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"),
        F.col("l_partkey") == F.col("p_partkey"),
        "left",
    )
    price = cents("l_extendedprice")
    return lines.select(
        F.concat(F.lit("ORD"), F.col("l_orderkey")).alias("order_id"),
        F.concat(F.lit("P"), F.col("l_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        from_cents(F.call_function("div", price, F.nullif(F.col("l_quantity").cast("bigint"), F.lit(0)))).alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("item_total"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as the shop's product list."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


RAW = {"orders": raw_orders, "payments": raw_payments, "user_events": raw_user_events}


def envelope(raw: DataFrame, topic: str) -> DataFrame:
    """Raw records of a topic as the messages a broker would deliver."""
    return to_envelope(
        raw,
        topic,
        key=raw.columns[0],
        body=[c for c in raw.columns if not c.startswith("kafka_")],
        partition=F.col("kafka_partition"),
        offset=F.col("kafka_offset"),
        at=F.col("kafka_timestamp"),
    )
