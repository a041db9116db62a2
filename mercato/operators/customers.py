"""Per-customer totals behind scoring and churn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.money import from_cents, half_up, total_cents

#: Totals of a customer that can be merged: all that the metrics are made of.
TOTALS = (
    "customer_id string, last_day date, total_orders bigint, amounts bigint, cents decimal(38,0), "
    "latest struct<event_timestamp:timestamp,order_id:string,customer_name:string,customer_email:string>"
)
_WIDE = "decimal(38,0)"


def customer_metrics(orders: DataFrame, as_of: str, by_identity: bool = False) -> DataFrame:
    """Last order day, order count and spend of each customer, and the days since.

    One aggregate by customer, combined before its shuffle: a customer becomes a row per task
    however many names the orders give. Name and e-mail are those of the latest order, of equal
    times the one of greatest id. ``by_identity=True`` has a row per (id, name, e-mail) instead.
    """
    totals = [
        F.max(F.col("date").try_cast("date")).alias("last_day"),
        F.count("order_id").alias("total_orders"),
        F.count("final_amount").alias("amounts"),
        total_cents("final_amount").alias("cents"),
    ]
    if by_identity:
        folded = orders.groupBy("customer_id", "customer_name", "customer_email").agg(*totals)
    else:
        who = F.struct("customer_name", "customer_email")
        latest = F.max_by(who, F.struct("event_timestamp", "order_id", "customer_name", "customer_email"))
        folded = orders.groupBy("customer_id").agg(latest.alias("who"), *totals).select("*", "who.*")
    return _metrics(folded, as_of)


def _metrics(folded: DataFrame, as_of: str) -> DataFrame:
    return folded.select(
        "customer_id",
        "customer_name",
        "customer_email",
        F.col("last_day").cast("string").alias("last_order_date"),
        F.datediff(F.lit(as_of).cast("date"), "last_day").alias("days_since_order"),
        "total_orders",
        from_cents(F.col("cents")).alias("total_revenue"),
        from_cents(half_up(F.col("cents"), F.col("amounts"))).alias("avg_order_value"),
    )


def customer_totals(orders: DataFrame) -> DataFrame:
    """Mergeable totals per customer, as :data:`TOTALS` has them; combined before the shuffle."""
    return orders.groupBy("customer_id").agg(
        F.max(F.col("date").try_cast("date")).alias("last_day"),
        F.count("order_id").alias("total_orders"),
        F.count("final_amount").alias("amounts"),
        total_cents("final_amount").cast(_WIDE).alias("cents"),
        F.max(F.struct("event_timestamp", "order_id", "customer_name", "customer_email")).alias("latest"),
    )


def merged_totals(before: DataFrame, more: DataFrame) -> DataFrame:
    """Totals of both, a row per customer of either; each side has a customer once."""
    a, b = before.alias("a"), more.alias("b")
    both = a.join(b, F.col("a.customer_id") == F.col("b.customer_id"), "full_outer")
    zero = F.lit(0)
    add = lambda c, kind: (F.coalesce(f"a.{c}", zero) + F.coalesce(f"b.{c}", zero)).cast(kind).alias(c)
    return both.select(
        F.coalesce("a.customer_id", "b.customer_id").alias("customer_id"),
        F.greatest("a.last_day", "b.last_day").alias("last_day"),
        add("total_orders", "bigint"), add("amounts", "bigint"), add("cents", _WIDE),
        F.greatest("a.latest", "b.latest").alias("latest"),
    )


def metrics_from_totals(totals: DataFrame, as_of: str) -> DataFrame:
    """What :func:`customer_metrics` gives, from merged totals."""
    return _metrics(totals.select("*", "latest.customer_name", "latest.customer_email"), as_of)
